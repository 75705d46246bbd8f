"""Column expressions on single cells. All run inside codegen; none is a UDF."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyloom.spec import literal

# Cell texts that stand for "no value".
NULL_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "N/A", "NA", "NONE", "NULL", "NaN", "None",
    "n/a", "n/a;n/a", "nan", "none", "null",
)
# Characters deleted from every cell, and a text deleted wherever it occurs.
STRIPPED_CHARS = "\t\r\n<>&"
STRIPPED_LITERAL = "undefined"
# Texts taken for true and false, besides what a cast accepts.
TRUE_WORDS = ("t", "tr", "tru", "true", "y", "ye", "yes", "on", "1")
FALSE_WORDS = ("f", "fa", "fal", "fals", "false", "n", "no", "of", "off", "0")
# Fixed value: a location that was not given.
NO_LOCATION = "- -"

LEADING_SPACE = r"(?U)^[\s\x1c-\x1f]+"
DAY_MICROS = 86_400_000_000.0


# Cleaning runs on every column of an extract, so its steps build SQL text: one
# expression per column instead of a tree of column objects.


def null_token(sql: str, tokens: Sequence[str] = NULL_TOKENS) -> str:
    listed = ", ".join(literal(t) for t in tokens)
    return f"CASE WHEN {sql} NOT IN ({listed}) THEN {sql} END"


def strip_chars(sql: str, chars: str = STRIPPED_CHARS) -> str:
    return f"translate({sql}, {literal(chars)}, '')"


def strip_literal(sql: str, text: str = STRIPPED_LITERAL) -> str:
    return f"replace({sql}, {literal(text)}, '')"


def clean_cell(sql: str) -> str:
    """Null tokens first: a cell emptied by the later steps stays ``''``, not null.

    Characters are deleted one by one, so only from cells that hold one.
    """
    held = " OR ".join(f"contains({sql}, {literal(c)})" for c in STRIPPED_CHARS)
    kept = f"CASE WHEN {held} THEN {strip_chars(sql)} ELSE {sql} END"
    listed = ", ".join(literal(t) for t in NULL_TOKENS)
    return f"CASE WHEN {sql} NOT IN ({listed}) THEN {strip_literal(kept)} END"


def left_trim(c: Column) -> Column:
    """Drop all leading white space (``ltrim`` would drop spaces only)."""
    return F.regexp_replace(c, LEADING_SPACE, "")


def concat_cols(cols: Sequence[Column], sep: str = " ") -> Column:
    """Join cells; one null part makes the result null."""
    parts: list[Column] = []
    for c in cols:
        parts += [F.lit(sep), c] if parts and sep else [c]
    return left_trim(F.concat(*parts))


def lnglat_text(c: Column, parity: bool = False) -> Column:
    """``lat,lng`` (or ``lat lng``) to ``lng lat``.

    ``parity`` turns only comma-separated pairs round and leaves a pair joined
    by a space as it is, which swaps the axes of providers that deliver the two
    halves in separate columns.
    """
    given = F.when(c != NO_LOCATION, c)
    parts = F.split(given, ",") if parity else F.split(F.trim(given), r"\s*,\s*|\s+")
    return F.array_join(F.reverse(parts), " ")


def point(c: Column) -> Column:
    """``lng lat`` text to a point; text that is not exactly two numbers fails."""
    refused = F.raise_error(F.concat(F.lit("not a point: "), c))
    return F.when(c.isNotNull(), F.coalesce(try_point(c), refused))


def try_point(c: Column) -> Column:
    """The same, with null for text that is not exactly two numbers."""
    parts = F.split(F.trim(c), r"\s+")
    lng, lat = (F.get(parts, i).try_cast("double") for i in (0, 1))
    whole = (F.size(parts) == 2) & lng.isNotNull() & lat.isNotNull()
    return F.when(whole, F.struct(lng.alias("lng"), lat.alias("lat")))


def latitude(p: Column, parity: bool = False) -> Column:
    """``parity`` reads the x axis, for data whose points are stored swapped."""
    return p["lng"] if parity else p["lat"]


def longitude(p: Column, parity: bool = False) -> Column:
    return p["lat"] if parity else p["lng"]


def phone_digits(c: Column) -> Column:
    """First 12 digits; null becomes ``'0'`` and a text without digits null.

    Not idempotent: that null turns into ``'0'`` on the next application.
    """
    digits = F.coalesce(F.regexp_replace(c, r"\D", ""), F.lit("0"))
    return F.left(F.nullif(digits, F.lit("")), F.lit(12))


def first_match(c: Column, pattern: str) -> Column:
    """First match of ``pattern``, null if there is none."""
    return F.regexp_substr(c, F.lit(pattern))


def boolean_text(c: Column, strict: bool = True) -> Column:
    word = F.lower(F.trim(c))
    return (
        F.when(word.isin(*TRUE_WORDS), True)
        .when(word.isin(*FALSE_WORDS), False)
        .otherwise(c.cast("boolean") if strict else c.try_cast("boolean"))
    )


def decimal_text(c: Column) -> Column:
    """Plain notation without trailing zeros. ``c`` must have a scale above 0."""
    return F.rtrim(F.rtrim(c.cast("string"), F.lit("0")), F.lit("."))


def elapsed_days(later: Column, earlier: Column) -> Column:
    """Fractional days between two instants."""
    return F.timestamp_diff("MICROSECOND", earlier, later).cast("double") / F.lit(DAY_MICROS)
