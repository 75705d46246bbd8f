"""Responses of the remote system to delivered payloads."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.spec import quoted

# The status of a stored record, and the text of a refused slice.
SUCCESS = "Success"
REFUSED = "errorlist"

# How markup characters are written inside a value.
ENTITIES = {"lt": "<", "gt": ">", "quot": '"', "apos": "'", "amp": "&"}

_RESULT = r"(?s)<result\b[^>]*>.*?</result>"
_REFERENCE = r"&(#[0-9]{1,7}|#[xX][0-9A-Fa-f]{1,6}|lt|gt|quot|apos|amp);"


def _decoded(text: Column) -> Column:
    """Character references as characters, each once; a CDATA section as it stands."""
    literal = F.regexp_extract(text, r"(?s)\A\s*<!\[CDATA\[(.*?)\]\]>\s*\z", 1)
    gaps = F.split(text, _REFERENCE, -1)
    names = F.regexp_extract_all(text, F.lit(_REFERENCE), F.lit(1))
    known = F.create_map(*[F.lit(x) for pair in ENTITIES.items() for x in pair])

    def char(name: Column) -> Column:
        hexed = F.conv(F.substring(name, 3, 6), 16, 10).cast("int")
        code = F.when(name.rlike("^#[xX]"), hexed).otherwise(F.substring(name, 2, 7).try_cast("int"))
        # the UTF-32 form of a code point is its number in four bytes
        wide = F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")
        return F.when(name.startswith("#"), wide).otherwise(F.element_at(known, name))

    plain = F.array_join(
        F.transform(gaps, lambda gap, i: F.concat(gap, F.coalesce(char(F.get(names, i)), F.lit("")))), ""
    )
    return F.when(F.ltrim(text).startswith("<![CDATA["), literal).when(F.contains(text, F.lit("&")), plain).otherwise(text)


def _named(fragment: Column, name: str) -> Column:
    """Undecoded text of the value under the element of that name, at any depth; empty if none."""
    value = r"((?:<!\[CDATA\[.*?\]\]>|[^<])*)"
    pattern = rf"""(?s)\bname\s*=\s*["']{re.escape(name)}["'][^>]*>\s*<value>{value}</value>"""
    return F.regexp_extract(fragment, pattern, 1)


def response_errors(df: DataFrame, text: str, keep: Sequence[str] = ()) -> DataFrame:
    """Every status that is not success, and every slice refused as a whole.

    ``status`` is null for a refused slice.
    """
    body = F.col(quoted(text))
    kept = [F.col(quoted(c)) for c in keep]
    refused = F.contains(body, F.lit(REFUSED))
    statuses = F.regexp_extract_all(body, F.lit(r"(?s)<status>(.*?)</status>"), F.lit(1))
    rows = F.when(refused, F.array(F.lit(None).cast("string"))).otherwise(
        F.filter(statuses, lambda s: s != SUCCESS)
    )
    return df.select(*kept, F.explode(rows).alias("status"))


def results(df: DataFrame, text: str, key: str, id_col: str = "ID", keep: Sequence[str] = ()) -> DataFrame:
    """Every result with its key and identifier, null where it names none, and its own text.

    Results become rows before anything is read from them, so each pattern runs once per
    result in compiled code, and only values with a reference or a section are decoded.
    """
    found = F.explode(F.regexp_extract_all(F.col(quoted(text)), F.lit(_RESULT), F.lit(0)))
    rows = df.select(*[F.col(quoted(c)) for c in keep], found.alias("result"))
    raw = rows.withColumns({"__key": _named(F.col("result"), key), "__id": _named(F.col("result"), id_col)})
    decoded = [F.nullif(_decoded(F.col(c)), F.lit("")).alias(name) for c, name in (("__key", key), ("__id", id_col))]
    return raw.select(*[F.col(quoted(c)) for c in keep], *decoded, "result")


def response_ids(
    df: DataFrame, text: str, key: str, id_col: str = "ID", keep: Sequence[str] = ()
) -> DataFrame:
    """Pairs of external key and remote identifier, matched by field name.

    A result that lacks either field gives no row here; ``response_unpaired`` lists it.
    """
    found = results(df, text, key, id_col, keep)
    return found.where(F.col(quoted(key)).isNotNull() & F.col(quoted(id_col)).isNotNull()).drop("result")


def response_unpaired(
    df: DataFrame, text: str, key: str, id_col: str = "ID", keep: Sequence[str] = ()
) -> DataFrame:
    """Results without a readable key or identifier, with their text, and results cut short."""
    found = results(df, text, key, id_col, keep)
    lacking = found.where(F.col(quoted(key)).isNull() | F.col(quoted(id_col)).isNull())
    rest = F.regexp_replace(F.col(quoted(text)), _RESULT, "")
    cut = F.regexp_extract(rest, r"(?s)<result\b.*", 0)
    none = F.lit(None).cast("string")
    short = df.select(*[F.col(quoted(c)) for c in keep], none.alias(key), none.alias(id_col), cut.alias("result"))
    return lacking.unionByName(short.where("result != ''"))
