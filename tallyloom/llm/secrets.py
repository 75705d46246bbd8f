"""Secrets in texts, with native expressions only.

Base kinds: ``assign`` (a secret-like name and its value), ``access`` (key identifiers) and
``hex``. The method adds candidate strings of high entropy: for each character class, runs of
its characters are walked with a window whose symbol counts change by one symbol in and one
out, so the Shannon entropy ``log2(w) - sum(c * log2(c)) / w`` is updated from two counts per
step. The counts are kept, a letter for each distinct symbol of the run, and never taken again. A run is reported when some window reaches the class's entropy, it is not on the allow
list and it overlaps no base span and no span of an earlier class. The classes are hex, base64
(a digit, a lower-case and an upper-case letter), lower case with digits and upper case with
digits; runs of letters alone are never reported.

Positions come from ``split`` and ``regexp_extract_all`` with one pattern: the lengths of the
texts between matches and of the matches add up to the offsets, in code points.

Defined cases: a null or empty text has no spans; repeated rows each get their result; only
the id and text columns are read. Texts are read whole; patterns are linear in them.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"(?<![0-9a-f])[0-9a-f]{32,}+"
KINDS = ("assign", "access", "hex")
CHUNK = 256


@dataclass(frozen=True)
class CharClass:
    """Runs of at least ``least`` of ``chars``, reported when a window reaches ``bits``."""

    name: str
    chars: str
    bits: float
    least: int = 20
    needs: str = "[0-9]"

    def pattern(self) -> str:
        return f"(?<![{self.chars}])[{self.chars}]{{{self.least},}}+"


CLASSES = (
    CharClass("entropy_hex", "0-9A-Fa-f", 3.0, needs="(?=.*[0-9])(?=.*[A-Fa-f])"),
    CharClass("entropy_base64", "A-Za-z0-9+/_=-", 3.8, needs="(?=.*[0-9])(?=.*[a-z])(?=.*[A-Z])"),
    # base36 and base32: fewer symbols, so the entropy of a random window is lower
    CharClass("entropy_lower", "a-z0-9", 3.5, needs="(?=.*[0-9])(?=.*[g-z])"),
    CharClass("entropy_upper", "A-Z0-9", 3.5, needs="(?=.*[0-9])(?=.*[G-Z])"),
)
WINDOW = 20
_NONE = 64  # the letter of a count of 0; a window's counts stay below 64 more

# Candidates that are no secrets: whole-string patterns.
ALLOW = (
    r"[0-9]+",
    r"[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}",
    r".*EXAMPLE.*",
    r"(?<same>.)\k<same>+",
)


def _located(df: DataFrame, name: str, pattern: str) -> DataFrame:
    """Adds ``name``: array of (s, e, hit) of the leftmost non-overlapping matches in ``text``."""
    has = F.col("text").rlike(pattern)
    df = df.withColumns(
        {
            f"{name}_hits": F.when(has, F.regexp_extract_all("text", F.lit(pattern), F.lit(0))),
            f"{name}_gaps": F.when(has, F.split("text", pattern, -1)),
        }
    )
    df = df.withColumn(
        f"{name}_steps",
        F.expr(f"transform({name}_hits, (h, i) -> cast(length(get({name}_gaps, i)) + length(h) as bigint))"),
    )
    # offsets of chunks first, then within a chunk, so that long lists stay near linear
    df = df.withColumn(
        f"{name}_sums",
        F.expr(
            f"transform(sequence(0, (size({name}_hits) - 1) div {CHUNK}), c -> "
            f"aggregate(slice({name}_steps, int(c) * {CHUNK} + 1, {CHUNK}), 0L, (a, x) -> a + x))"
        ),
    )
    df = df.withColumn(
        f"{name}_starts",
        F.expr(
            f"transform({name}_hits, (h, i) -> length(get({name}_gaps, i))"
            f" + aggregate(slice({name}_sums, 1, int(i div {CHUNK})), 0L, (a, x) -> a + x)"
            f" + aggregate(slice({name}_steps, int(i div {CHUNK}) * {CHUNK} + 1, i % {CHUNK}), 0L, (a, x) -> a + x))"
        ),
    )
    spans = F.expr(
        f"coalesce(transform({name}_hits, (h, i) -> named_struct('s', get({name}_starts, i), "
        f"'e', get({name}_starts, i) + length(h), 'hit', h)), array())"
    )
    parts = [f"{name}_{x}" for x in ("hits", "gaps", "steps", "sums", "starts")]
    return df.withColumn(name, spans).drop(*parts)


def window_entropy(text: Column, window: int = WINDOW) -> Column:
    """The largest Shannon entropy, in bits, of any ``window`` symbols of ``text``; 0 for a shorter text."""

    symbols = F.split(text, "")
    alphabet = F.array_join(F.array_distinct(symbols), "")
    # the symbol that comes in, and the one that leaves as it does, as places in the alphabet
    moves = F.transform(
        symbols,
        lambda x, i: F.struct(
            F.position(x, alphabet).alias("came"),
            F.when(i >= window, F.position(F.get(symbols, i - window), alphabet)).alias("gone"),
            (i >= window - 1).alias("full"),
        ),
    )

    def weight(count: Column) -> Column:
        return F.when(count > 1, count * F.log2(count.cast("double"))).otherwise(F.lit(0.0))

    def held(counts: Column, place: Column) -> Column:
        return F.ascii(F.substr(counts, place, F.lit(1))) - _NONE

    def put(counts: Column, place: Column, count: Column) -> Column:
        return F.overlay(counts, F.char(count + _NONE), place)

    def step(acc: Column, move: Column) -> Column:
        left = held(acc["counts"], move["gone"])
        counts = F.when(move["gone"].isNull(), acc["counts"]).otherwise(put(acc["counts"], move["gone"], left - 1))
        total = F.when(move["gone"].isNull(), acc["sum"]).otherwise(acc["sum"] + weight(left - 1) - weight(left))
        return F.struct(counts.alias("counts"), total.alias("sum"), move.alias("move"), acc["best"].alias("best"))

    def enter(acc: Column) -> Column:
        place = acc["move"]["came"]
        count = held(acc["counts"], place)
        total = acc["sum"] + weight(count + 1) - weight(count)
        bits = F.log2(F.lit(float(window))) - total / window
        best = F.when(acc["move"]["full"], F.greatest(acc["best"], bits)).otherwise(acc["best"])
        return F.struct(put(acc["counts"], place, count + 1).alias("counts"), total.alias("sum"), acc["move"].alias("move"), best.alias("best"))

    none = F.struct(F.lit(1).alias("came"), F.lit(None).cast("int").alias("gone"), F.lit(False).alias("full"))
    start = F.struct(F.repeat(F.lit(chr(_NONE)), F.length(alphabet)).alias("counts"), F.lit(0.0).alias("sum"), none.alias("move"), F.lit(0.0).alias("best"))
    # each step is two: one symbol out, one in
    return F.aggregate(moves, start, lambda acc, move: enter(step(acc, move)), lambda acc: acc["best"])


def find_secrets(
    docs: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    classes: tuple[CharClass, ...] = CLASSES,
    allow: tuple[str, ...] = ALLOW,
    window: int = WINDOW,
) -> DataFrame:
    """Per row: base counts, digest of the base spans, all spans as ``kind:start:end``, n_added."""
    df = docs.select(F.col(id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    for name, pattern in (("assign", ASSIGN), ("access", ACCESS), ("hex", HEX)):
        df = _located(df, name, pattern)
    df = df.withColumn(
        "assign", F.filter("assign", lambda x: F.length(F.regexp_extract(x["hit"], ASSIGN, 2)) >= 8)
    )
    df = df.withColumn("base", _listed([(k, F.col(k)) for k in KINDS], 0)).withColumn("named", F.concat("assign", "access"))
    allowed = "^(?:" + "|".join(f"(?:{p})" for p in allow) + ")$"
    for n, c in enumerate(classes):
        df = _located(df, c.name, c.pattern())
        df = df.withColumn(c.name, F.filter(c.name, _suspect(c, allowed, window, ["named", *(x.name for x in classes[:n])])))
    df = df.withColumn("added", _listed([(c.name, F.col(c.name)) for c in classes], len(KINDS)))
    names = [*KINDS, *(c.name for c in classes)]
    return df.select(
        "doc_id",
        *[F.size(k).cast("long").alias(f"n_{k}") for k in KINDS],
        F.sha2(_text(F.sort_array("base"), names), 256).alias("base_sha256"),
        _text(F.sort_array(F.concat("base", "added")), names).alias("spans"),
        F.size("added").cast("long").alias("n_added"),
    )



def _suspect(c: CharClass, allowed: str, window: int, before: list[str]) -> Callable[[Column], Column]:
    def keep(x: Column) -> Column:
        # a class holds all lower-case hex digits or no letter of them, so a hex span lies inside a run that holds one
        shaped = x["hit"].rlike(f"^{c.needs}") & ~x["hit"].rlike(allowed) & ~x["hit"].rlike(HEX)
        free = F.lit(True)
        for spans in before:
            free = free & ~F.exists(spans, lambda b: (b["s"] < x["e"]) & (x["s"] < b["e"]))
        return shaped & free & (window_entropy(x["hit"], window) >= c.bits)

    return keep


def _listed(kinds: list[tuple[str, Column]], first: int) -> Column:
    """All spans as (s, kind number, e), to be sorted by start, then kind."""

    def numbered(n: int) -> Callable[[Column], Column]:
        return lambda x: F.struct(x["s"].alias("s"), F.lit(n).alias("k"), x["e"].alias("e"))

    return F.concat(*[F.transform(spans, numbered(n)) for n, (_, spans) in enumerate(kinds, first)])


def _text(spans: Column, names: list[str]) -> Column:
    listed = F.array(*[F.lit(n) for n in names])
    return F.array_join(
        F.transform(spans, lambda x: F.concat_ws(":", F.get(listed, x["k"]), x["s"].cast("string"), x["e"].cast("string"))), ","
    )
