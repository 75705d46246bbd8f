"""What became of delivered records: their state, and which records are sent again.

A ledger holds one row per business key: ``key``, ``run``, ``known``, ``batch_id``, ``part``,
``digest`` of the record that was sent, ``state``, ``status`` and ``remote_id``. States are

- ``sent``: no response to its payload is known;
- ``acknowledged``: the response pairs it with an identifier;
- ``refused``: its payload was refused as a whole, or its own result is not a success;
- ``unpaired``: its payload was answered, but no readable result names it, so the remote
  system may or may not hold it;
- ``oversize``: no payload can hold it.

``delivered`` is the digest acknowledged last, whatever was sent since.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.operators.respond import REFUSED, SUCCESS, results
from tallyloom.spec import quoted

SENT, ACKNOWLEDGED, REFUSED_STATE, UNPAIRED, OVERSIZE = "sent", "acknowledged", "refused", "unpaired", "oversize"

LEDGER = (
    "key string, run string, known boolean, batch_id bigint, part int, digest string, state string, "
    "status string, remote_id bigint, delivered string"
)
_BATCH = ["batch_id", "part"]


def digest(record: Column) -> Column:
    """What tells two renderings of a record apart."""
    return F.sha2(record, 256)


def member_states(members: DataFrame, responses: DataFrame, text: str, key: str, id_col: str = "ID") -> DataFrame:
    """``members`` (batch_id, part, key, ..) with ``state``, ``status`` and ``remote_id``.

    ``responses`` has one row per answered payload: batch_id, part and the ``text``. Of several
    results of a key a success with the smallest identifier counts.
    """
    answered = responses.groupBy(*_BATCH).agg(F.bool_or(F.contains(quoted(text), F.lit(REFUSED))).alias("__refused"))
    found = results(responses, text, key, id_col, _BATCH)
    status = F.regexp_extract("result", r"(?s)<status>(.*?)</status>", 1)
    found = found.where(F.col(quoted(key)).isNotNull()).select(
        *_BATCH, F.col(quoted(key)).alias("key"), status.alias("status"), F.col(quoted(id_col)).try_cast("bigint").alias("remote_id")
    )
    best = F.min(F.struct((F.col("status") != SUCCESS).alias("bad"), F.col("remote_id").isNull().alias("none"), "remote_id", "status"))
    found = found.groupBy(*_BATCH, "key").agg(best.alias("__best"))
    joined = members.join(answered, _BATCH, "left").join(found, [*_BATCH, "key"], "left")
    stored = ~F.col("__best.bad") & ~F.col("__best.none")
    state = (
        F.when(F.col("__refused").isNull(), SENT)
        .when(F.col("__refused"), REFUSED_STATE)
        .when(F.col("__best").isNull(), UNPAIRED)
        .when(stored, ACKNOWLEDGED)
        .when(F.col("__best.bad"), REFUSED_STATE)
        .otherwise(UNPAIRED)
    )
    return joined.select(
        *members.columns,
        state.alias("state"),
        F.col("__best.status").alias("status"),
        F.when(stored, F.col("__best.remote_id")).alias("remote_id"),
    )


def _packed(text: Column) -> Column:
    """A digest as it is shuffled: half as long as its text; other texts as they are."""
    hexed = text.rlike(r"\A[0-9a-f]{64}\z")
    return F.struct(F.when(hexed, F.unhex(text)).alias("raw"), F.when(~hexed, text).alias("text"))


def _unpacked(packed: Column) -> Column:
    return F.coalesce(F.lower(F.hex(packed["raw"])), packed["text"])


def started(events: DataFrame) -> DataFrame:
    """The ledger after its first ``events``."""
    delivered = F.when(F.col("state") == ACKNOWLEDGED, F.col("digest"))
    kinds = dict(c.split() for c in LEDGER.split(", "))
    return events.withColumn("delivered", delivered).select(*[F.col(c).cast(k).alias(c) for c, k in kinds.items()])


def entered(ledger: DataFrame, events: DataFrame) -> DataFrame:
    """The ledger after ``events``, one per key, in its own columns but ``delivered``.

    An event replaces the key's row; an acknowledged one makes its digest the delivered one.
    Events on what the ledger holds already may come without a digest: that of the row stays.
    """
    given = "digest" in events.columns
    names = [c for c in ledger.columns if c not in ("key", "digest", "delivered")]
    held = [_packed(F.col(c)).alias(f"__{c}") for c in ("digest", "delivered")]
    old = ledger.select("key", F.struct(*names).alias("__old"), *held)
    fresh = [_packed(F.col("digest").cast("string")).alias("__fresh")] if given else []
    new = events.select("key", F.struct(*[F.col(c).cast(ledger.schema[c].dataType).alias(c) for c in names]).alias("__new"), *fresh)
    both = old.join(new, "key", "full_outer")
    row = F.coalesce("__new", "__old")
    digest = F.when(F.col("__new").isNotNull(), F.col("__fresh")).otherwise(F.col("__digest")) if given else F.col("__digest")
    delivered = F.when(F.col("__new.state") == ACKNOWLEDGED, digest).otherwise(F.col("__delivered"))
    done = both.select("key", row.alias("__row"), _unpacked(digest).alias("digest"), _unpacked(delivered).alias("delivered"))
    own = ("key", "digest", "delivered")
    return done.select(*[F.col(c) if c in own else F.col(f"__row.{c}").alias(c) for c in ledger.columns])


def to_send(records: DataFrame, ledger: DataFrame, known: bool, key: Column | None = None, mark: Column | None = None) -> DataFrame:
    """The ``records`` (key, digest, ..) that have to be sent.

    New records wait while an earlier payload with them is unanswered, unpaired or
    acknowledged; sending them again could store them twice. Known records are sent if their
    digest is not the delivered one and no payload with that digest is unanswered. A record
    that no payload can hold waits until it has changed.

    ``key`` and ``mark`` give key and digest of records that are not rendered yet, so that
    they meet the ledger without their text.
    """
    key = F.col("key") if key is None else key
    mark = F.col("digest") if mark is None else mark
    if known:
        done = ledger.where(F.col("delivered").isNotNull() & (F.col("state") != SENT)).select("key", F.col("delivered").alias("digest"))
        waiting = ledger.where(F.col("state").isin(SENT, OVERSIZE)).select("key", "digest")
        gone = done.union(waiting).toDF("__key", "__digest")
        return records.join(gone, (key == F.col("__key")) & (mark == F.col("__digest")), "left_anti")
    large = F.col("state") == OVERSIZE
    gone = ledger.where(F.col("state").isin(SENT, UNPAIRED, ACKNOWLEDGED, OVERSIZE)).select(
        F.col("key").alias("__key"), (~large).alias("__held"), F.when(large, F.col("digest")).alias("__digest")
    )
    return records.join(gone, (key == F.col("__key")) & (F.col("__held") | (mark == F.col("__digest"))), "left_anti")


def confirmed(ledger: DataFrame, report: DataFrame, complete: bool) -> DataFrame:
    """Events for unpaired keys from a ``report`` (key, remote_id) of what the remote system holds.

    Keys in it are acknowledged. Those a ``complete`` report lacks were never stored: they are
    refused, and so sent again.
    """
    open_ = ledger.where(F.col("state") == UNPAIRED).drop("state", "remote_id", "delivered")
    held = report.where(F.col("key").isNotNull() & F.col("remote_id").isNotNull()).groupBy("key").agg(F.min("remote_id").cast("bigint").alias("remote_id"))
    found = open_.join(held, "key", "left" if complete else "inner")
    return found.withColumn("state", F.when(F.col("remote_id").isNotNull(), ACKNOWLEDGED).otherwise(REFUSED_STATE))
