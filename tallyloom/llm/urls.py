"""URL verdicts from pattern rules that are found by one literal token each.

A rule is a site rule (``host/path``: the host and its subdomains, paths that start so) or a
pattern (``*`` is any text, the rest literal, case ignored, over the whole URL). Every rule
is filed under the rarest, over the given URLs, of the literal tokens (``[a-z0-9]+``) that
each fitting URL must contain whole. The tokens of a URL fetch candidate rules by an
equi-join, and only candidates run their regular expression.

Defined cases: a URL that is null or has no ``://`` has host and path ``''``, fits no site
rule, and a null one no pattern either. Rules without a token are tried on every URL. Equal
URLs are judged once; repeated rows keep their count. Of several fitting site rules the
longest wins, then the smallest text; block beats allow between equal texts. Other input
columns are not read, so their names cannot clash. No rules: everything is allowed.
"""

from __future__ import annotations

import re
import string
from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ALLOW, BLOCK = "allow", "block"
PARTS = r"(?s)\A.*?://([^/?#]*)([^?#]*)"


@dataclass(frozen=True)
class Rule:
    text: str
    verdict: str = BLOCK
    site: bool = True

    def regex(self) -> str:
        """Over host and path joined (site) or the lower-cased URL (pattern)."""
        if self.site:
            return r"(?s)\A(?:[^/]*\.)?" + _quote(self.text)
        return "(?s)" + ".*".join(_quote(_ascii_lower(x)) for x in self.text.split("*"))

    def tokens(self) -> list[str]:
        """Tokens that every fitting URL holds whole: those with a literal neighbour on either side."""
        text = _ascii_lower(self.text)
        found = []
        for m in re.finditer("[a-z0-9]+", text):
            before = text[m.start() - 1] if m.start() else ("." if self.site else "*")
            after = text[m.end()] if m.end() < len(text) else "*"
            if before != "*" and after != "*":
                found.append(m[0])
        return sorted(set(found))


# Default patterns of the operator for URLs that no site rule decides.
PATTERNS = tuple(
    Rule(f"*{edge}{host}.*", BLOCK, site=False) for host in ("spam-farm", "cheap-pills", "casino-win", "ads") for edge in ("/", ".")
) + (
    Rule("*/login/*", BLOCK, site=False),
    Rule("*/cgi-bin/*", BLOCK, site=False),
    Rule("*/tag/*", BLOCK, site=False),
    Rule("*/ads/*", BLOCK, site=False),
    Rule("*/tag/press/*", ALLOW, site=False),
)


def _ascii_lower(text: str) -> str:
    return text.translate(str.maketrans(string.ascii_uppercase, string.ascii_lowercase))


def _quote(text: str) -> str:
    return re.sub(r"([^A-Za-z0-9/ ])", r"\\\1", text)


def _lower(col):
    return F.translate(col, string.ascii_uppercase, string.ascii_lowercase)


def index_rules(tokens: DataFrame, rules: Iterable[Rule]) -> DataFrame:
    """One row per rule: the token it is filed under (null if it has none) and what it needs to run.

    ``tokens`` holds a row per URL and token; the rarest token by its rows is taken, then the
    smallest text.
    """
    spark = tokens.sparkSession
    schema = "text string, verdict string, site boolean, regex string, tokens array<string>"
    listed = spark.createDataFrame([(r.text, r.verdict, r.site, r.regex(), r.tokens()) for r in set(rules)], schema)
    wanted = listed.select(F.explode("tokens").alias("token")).distinct()
    # counts combine before the shuffle; only the rules' own tokens are counted
    seen = tokens.join(wanted, "token", "left_semi").groupBy("token").agg(F.count("*").alias("urls"))
    pairs = listed.select("regex", "verdict", F.explode("tokens").alias("token")).join(seen, "token", "left")
    rarest = pairs.groupBy("regex", "verdict").agg(
        F.min(F.struct(F.coalesce("urls", F.lit(0)).alias("urls"), "token")).alias("least")
    )
    return listed.join(rarest, ["regex", "verdict"], "left").select(
        "text", "verdict", "site", "regex", F.col("least.token").alias("token")
    )


def judge_urls(pages: DataFrame, rules: Sequence[Rule], key: Sequence[str] = ("page_id",), url: str = "url") -> DataFrame:
    """``key``, host, path, rule (the deciding site rule or null), verdict and n_candidates per row."""
    rows = pages.select(*[F.col(k).alias(f"k{i}") for i, k in enumerate(key)], F.col(url).alias("url"))
    lowered = _lower(F.col("url"))
    urls = rows.where("url is not null").select("url").distinct()
    urls = urls.select(
        "url",
        lowered.alias("whole"),
        F.concat(_lower(F.regexp_extract("url", PARTS, 1)), F.regexp_extract("url", PARTS, 2)).alias("place"),
    )
    tokens = urls.select(
        "url", "whole", "place", F.explode(F.array_distinct(F.split(F.col("whole"), "[^a-z0-9]+"))).alias("token")
    ).where("token != ''")
    index = index_rules(tokens.select("token"), rules)
    candidates = tokens.join(index.where("token is not null"), "token").drop("token")
    if any(not r.tokens() for r in rules):
        # the few rules without a token run on every URL, as a literal array
        loose = urls.withColumn("loose", F.explode(_literals(rules))).select("url", "whole", "place", "loose.*")
        candidates = candidates.unionByName(loose)
    fits = candidates.where(F.expr("case when site then place rlike regex else whole rlike regex end"))
    judged = fits.groupBy("url").agg(
        F.min(
            F.when(F.col("site"), F.struct(-F.length("text"), "text", F.when(F.col("verdict") == BLOCK, 0).otherwise(1).alias("v"), "verdict"))
        ).alias("best"),
        F.max(F.expr(f"not site and verdict = '{BLOCK}'")).alias("blocked"),
        F.max(F.expr(f"not site and verdict = '{ALLOW}'")).alias("allowed"),
    )
    method = F.when(F.col("blocked") & ~F.col("allowed"), BLOCK).otherwise(ALLOW)
    named = rows.where("url is not null").join(judged, "url", "left")
    named = named.unionByName(rows.where("url is null"), allowMissingColumns=True)
    return named.select(
        *[F.col(f"k{i}").alias(k) for i, k in enumerate(key)],
        F.coalesce(_lower(F.regexp_extract("url", PARTS, 1)), F.lit("")).alias("host"),
        F.coalesce(F.regexp_extract("url", PARTS, 2), F.lit("")).alias("path"),
        F.col("best.text").alias("rule"),
        F.coalesce("best.verdict", method).alias("verdict"),
    )


def _literals(rules: Iterable[Rule]):
    """The rules without a token."""
    fields = ("text", "verdict", "site", "regex")
    loose = [(r.text, r.verdict, r.site, r.regex()) for r in dict.fromkeys(rules) if not r.tokens()]
    return F.array(*[F.struct(*[F.lit(v).alias(n) for n, v in zip(fields, r, strict=True)]) for r in loose])
