"""Outbound records: selection, rendering and payloads."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom.functions.cells import decimal_text
from tallyloom.operators.conform import delivered_columns, outbound_select
from tallyloom.operators.numbering import assign_batches
from tallyloom.spec import Delivery, Field, Mapping, quoted

# Fixed value: payloads above this many characters are refused by the receiver.
MAX_PAYLOAD_CHARS = 1_350_000


def deliverable(
    core: DataFrame,
    fields: Sequence[Field],
    known: bool,
    remote_id: str = "remote_id",
    since: Column | None = None,
) -> DataFrame:
    """Live records that the remote system does not (``known``: does) hold.

    All known records are selected, changed or not; ``since`` narrows them to
    rows touched after an instant.
    """
    has_id = F.col(quoted(remote_id)).isNotNull()
    rows = core.filter((has_id if known else ~has_id) & (F.col("archived") == F.lit(False)))
    if since is not None:
        rows = rows.filter(F.col("change_timestamp") > since)
    return outbound_select(rows, fields, remote_id)


def delivery(
    core: DataFrame,
    mapping: Mapping,
    spec: Delivery,
    known: bool,
    remote_id: str = "remote_id",
    since: Column | None = None,
) -> DataFrame:
    """Records of one delivery pass.

    A spec may override the selection of known records by SQL over the core
    table; ``{columns}`` stands for the delivered columns, ``{core}`` for the table.
    """
    fields = mapping.resolve(spec.table, system=True, outbound=True)
    if not (known and spec.update_sql):
        return deliverable(core, fields, known, remote_id, since)
    names = core.columns
    given = [f.name for f in fields]
    delivered = delivered_columns(names, fields, remote_id)
    others = [quoted(c) for c in names if c not in given]
    columns = ", ".join(c.split(" AS ")[-1] for c in delivered)
    sql = spec.update_sql.replace("{columns}", columns)
    return core.sparkSession.sql(sql, core=core.selectExpr(*delivered, *others))


def value_text(c: Column, kind: T.DataType) -> Column:
    """A value as it is written into a payload."""
    if isinstance(kind, T.DecimalType):
        return decimal_text(c) if kind.scale > 0 else c.cast("string")
    if isinstance(kind, T.BooleanType):
        return F.initcap(c.cast("string"))
    if isinstance(kind, T.TimestampNTZType | T.TimestampType):
        whole = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        micros = F.date_format(c, "SSSSSS")
        return F.when(micros == "000000", whole).otherwise(F.concat_ws(".", whole, micros))
    if isinstance(kind, T.StructType):
        return F.when(
            c.isNotNull(), F.concat(F.lit("POINT("), c["lng"], F.lit(" "), c["lat"], F.lit(")"))
        )
    return c.cast("string")


def escaped(c: Column) -> Column:
    for char, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        c = F.replace(c, F.lit(char), F.lit(entity))
    return c


def _field(name: str, value: Column) -> Column:
    return F.concat(F.lit(f'<field name="{name}"><value>'), value, F.lit("</value></field>"))


def add_record(df: DataFrame, cols: Sequence[str]) -> Column:
    """A new record: null and empty fields are left out."""
    fields = []
    for name in cols:
        text = value_text(F.col(quoted(name)), df.schema[name].dataType)
        fields.append(F.when(text != "", _field(name, escaped(text))))
    return F.concat(F.lit("<add>"), F.concat_ws("", *fields), F.lit("</add>"))


def update_record(df: DataFrame, cols: Sequence[str], id_col: str = "ID") -> Column:
    """A known record: empty fields are left out, nulls are sent as empty values."""
    fields = []
    for name in cols:
        if name == id_col:
            continue
        text = value_text(F.col(quoted(name)), df.schema[name].dataType)
        fields.append(
            F.when(text.isNull(), F.lit(f'<field name="{name}"><value></value></field>')).when(
                text != "", _field(name, escaped(text))
            )
        )
    criteria = F.concat(
        F.lit(f'<update><criteria>{id_col}=="'),
        value_text(F.col(quoted(id_col)), df.schema[id_col].dataType),
        F.lit('"</criteria><newvalues>'),
    )
    return F.concat(criteria, F.concat_ws("", *fields), F.lit("</newvalues></update>"))


def render_add(df: DataFrame, cols: Sequence[str] | None = None, out: str = "record") -> DataFrame:
    return df.withColumn(out, add_record(df, cols or df.columns))


def render_update(
    df: DataFrame, cols: Sequence[str] | None = None, id_col: str = "ID", out: str = "record"
) -> DataFrame:
    return df.withColumn(out, update_record(df, cols or df.columns, id_col))


def envelope(root: str, application: str, form: str) -> tuple[str, str]:
    """What stands before and after the records of a payload."""
    head = (
        f'<{root}><applicationlist><application name="{application}">'
        f'<formlist><form name="{form}">'
    )
    return head, f"</form></formlist></application></applicationlist></{root}>"


def build_payloads(
    df: DataFrame,
    order: Sequence[str],
    root: str,
    application: str,
    form: str,
    batch: str = "batch_id",
    record: str = "record",
) -> DataFrame:
    """One payload per batch: its records in order, inside the envelope.

    A group holds one batch, so its size is bounded by the batch size.
    """
    head, tail = envelope(root, application, form)
    rows = F.struct(*[F.col(quoted(c)) for c in order], F.col(record).alias("__record"))
    ordered = F.transform(F.array_sort(F.collect_list(rows)), lambda r: r["__record"])
    return (
        df.groupBy(batch)
        .agg(F.count(F.lit(1)).alias("records"), F.array_join(ordered, "").alias("body"))
        .select(
            batch,
            "records",
            F.concat(F.lit(head), F.col("body"), F.lit(tail)).alias("payload"),
        )
    )


def split_oversize(
    df: DataFrame, chars: int, record: str = "record"
) -> tuple[DataFrame, DataFrame]:
    """Records that a payload with room for ``chars`` characters can hold, and those it cannot."""
    fits = F.coalesce(F.length(record) <= chars, F.lit(True))
    return df.where(fits), df.where(~fits)


def _cuts(lengths: Column, chars: int) -> Column:
    """For each of some records, in order, the number of the payload it goes into.

    A payload takes records as long as they fit; the next one starts a new payload.
    """
    start = F.struct(
        F.array().cast("array<int>").alias("parts"), F.lit(0).alias("part"), F.lit(0).alias("used")
    )

    def step(acc: Column, n: Column) -> Column:
        full = (acc["used"] > 0) & (acc["used"] + n > chars)
        part = F.when(full, acc["part"] + 1).otherwise(acc["part"])
        used = F.when(full, n).otherwise(acc["used"] + n)
        return F.struct(
            F.array_append(acc["parts"], part).alias("parts"), part.alias("part"), used.alias("used")
        )

    return F.aggregate(lengths, start, step, lambda acc: acc["parts"])


def bounded_payloads(
    df: DataFrame,
    order: Sequence[str],
    size: int,
    root: str,
    application: str,
    form: str,
    limit: int = MAX_PAYLOAD_CHARS,
    keep: Sequence[str] = (),
    record: str = "record",
    texts: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Payloads of at most ``size`` records and ``limit`` characters, in order.

    Records are cut into batches of ``size``, as ever; a batch whose payload would be longer
    than ``limit`` is cut again, into parts that each take the next records as long as they
    fit. So a long record moves no other batch, and a group is one batch. ``members`` holds
    the ``keep`` columns of each part's records. Records too long for any payload must be set
    aside before (``split_oversize``). ``texts`` renders rows that come without their record;
    it runs where the batches are put together, so no text is sorted or shuffled.
    """
    head, tail = envelope(root, application, form)
    if texts is None:
        batched = assign_batches(df, order, size)
    else:
        batched = texts(assign_batches(df, order, size, "__batch").repartition("__batch"))
        batched = batched.withColumnRenamed("__batch", "batch_id")
    names = list(dict.fromkeys([*order, *keep]))
    row = F.struct(*[F.col(quoted(c)) for c in names], F.col(record).alias("__record"))
    grouped = batched.groupBy("batch_id").agg(F.array_sort(F.collect_list(row)).alias("rows"))
    lengths = F.transform("rows", lambda r: F.coalesce(F.length(r["__record"]), F.lit(0)))
    cut = grouped.withColumn("cuts", _cuts(lengths, limit - len(head) - len(tail)))
    parts = F.sequence(F.lit(0), F.element_at("cuts", -1))
    cut = cut.select("batch_id", "rows", "cuts", F.explode(parts).alias("part"))
    own = F.filter("rows", lambda r, i: F.get("cuts", i) == F.col("part"))
    cut = cut.select("batch_id", "part", own.alias("rows"))
    body = F.array_join(F.transform("rows", lambda r: r["__record"]), "")
    members = F.transform("rows", lambda r: F.struct(*[r[c].alias(c) for c in keep])) if keep else None
    return cut.select(
        "batch_id",
        "part",
        F.size("rows").cast("bigint").alias("records"),
        *([members.alias("members")] if keep else []),
        F.concat(F.lit(head), body, F.lit(tail)).alias("payload"),
    )


def oversize(payloads: DataFrame, limit: int = MAX_PAYLOAD_CHARS) -> DataFrame:
    """Payloads the receiver would refuse."""
    return payloads.filter(F.length("payload") > limit)
