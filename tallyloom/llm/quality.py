"""Quality rules whose cutoffs carry a guarantee, with native expressions only.

``measure`` turns a text into counts, ``fit`` selects cutoffs, ``judge`` applies them.

Cutoffs: labelled documents are split by a hash of their id. A quarter of them, the proposal
fold, gives each stratum a ladder of rules, from loose to strict. A rule has a cutoff for every
feature and rejects what exceeds any of them: multiples of the largest value among the fold's
good documents, and somewhat more, first, then that value, then ever lower quantiles. Each rule rejects all that
the one before it rejects. The other documents, the holdout, test the ladder in this order: with
x of n good documents rejected, the exact binomial probability of at most x rejections at the
allowed rate ``alpha`` is the p-value of "this rule rejects too many". The climb ends at the
first rule that does not pass, and the last one that did is taken. Tests in a fixed order that
ends with the first failure need no correction among themselves; over the strata ``delta`` is
shared out evenly (Bonferroni). So with probability ``1 - delta`` no stratum loses more than
``alpha`` of its good documents to its rule. About 220 holdout documents let a rule of four
strata pass at 2 %; a stratum with fewer, or none, rejects by the base rules alone.

Defined cases: a null text has no words; a null stratum is one of its own; null labels are
ignored, a document labelled both ways counts once per distinct label. Repeated rows each
get the same result. Empty labels: no cutoffs. Texts are read whole.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.session import freeze

SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"
SYMBOL = "[#*$%&|<>]"
WINDOW = 8  # a power of two

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
# Larger is worse for each of these.
FEATURES = {
    "symbol_share": "n_symbols / greatest(word_chars, 1)",
    "repeat_share": "n_repeat_words / greatest(n_words, 1)",
    "dup_line_share": "n_dup_lines / greatest(n_lines, 1)",
    "long_words": "word_chars / greatest(n_words, 1)",
}
# The ladder, from loose to strict: multiples of the largest good value, then quantiles. A
# multiple m allows SLACK * (m - 1) more, since the largest value of a small fold may be 0.
MULTIPLES = (5.0, 3.0, 2.0, 1.5, 1.25, 1.1, 1.0)
SLACK = 0.1
QUANTILES = (0.998, 0.995, 0.99, 0.985, 0.98)
FOLDS = 4  # one of them proposes
ALPHA = 0.02
DELTA = 0.05
BASE_FAILED = "n_words < 20 or 100 * n_repeat_words > 30 * n_words"
MAX_BROADCAST_STRATA = 10_000


def measure(docs: DataFrame, text: str = "text", into: str = "q") -> DataFrame:
    """``docs`` with the counts of each text as the struct column ``into``, which replaces one of that name."""
    kept = [c for c in docs.columns if c.lower() != into.lower()]
    t = F.coalesce(F.col(text), F.lit(""))
    df = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row"),
        F.filter(F.split(t, f"{SPACE}+", -1), lambda w: w != "").alias("words"),
        F.filter(F.split(t, "\n", -1), lambda x: x.rlike(WORD)).alias("lines"),
        F.regexp_count(t, F.lit(SYMBOL)).cast("long").alias("n_symbols"),
    )
    df = df.select(
        "row",
        "n_symbols",
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.size("words").cast("long").alias("n_words"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.expr("transform(words, w -> xxhash64(w))").alias("h1"),
    )
    # hashes of 2, 4 and 8 words from those of half as many
    span = 1
    while span < WINDOW:
        pair = f"transform(slice(h{span}, 1, greatest(size(h{span}) - {span}, 0)), (x, i) -> xxhash64(x, get(h{span}, i + {span})))"
        df = df.withColumn(f"h{2 * span}", F.expr(pair)).drop(f"h{span}")
        span *= 2
    df = df.withColumnRenamed(f"h{WINDOW}", "windows")
    # positions are only sorted where some window is found twice
    df = df.withColumn(
        "sorted",
        F.expr(
            "if(size(array_distinct(windows)) = size(windows), array(),"
            " sort_array(transform(windows, (h, i) -> struct(h, i))))"
        ),
    )
    df = df.withColumn(
        "places",
        F.expr(
            "sort_array(transform(filter(sorted, (x, i) ->"
            " coalesce(get(sorted, i - 1).h = x.h, false) or coalesce(get(sorted, i + 1).h = x.h, false)), x -> x.i))"
        ),
    )
    repeat = F.expr(
        f"aggregate(transform(places, (p, i) -> least({WINDOW}, coalesce(get(places, i + 1) - p, {WINDOW}))),"
        " 0L, (a, x) -> a + x)"
    )
    df = df.withColumn("n_repeat_words", repeat)
    # a generator keeps later filters above it: pushed down, they would repeat the steps above
    df = df.select(F.explode(F.array(F.struct("row", F.struct(*COUNTS, "n_lines").alias("q")))).alias("x"))
    return df.select(*[F.col("x.row").getField(c).alias(c) for c in kept], F.col("x.q").alias(into))


def _features(q: str) -> Column:
    """The features of the counts struct ``q`` as one array of (name, value)."""

    def value(sql: str) -> str:
        for name in (*COUNTS, "n_lines"):
            sql = sql.replace(name, f"{q}.{name}") if f"{q}.{name}" not in sql else sql
        return sql

    pairs = [f"named_struct('name', '{n}', 'value', cast({value(sql)} as double))" for n, sql in FEATURES.items()]
    return F.expr(f"array({', '.join(pairs)})")


def base_failed(q: str) -> Column:
    return F.expr(BASE_FAILED.replace("n_words", f"{q}.n_words").replace("n_repeat_words", f"{q}.n_repeat_words"))


def binomial_cdf(x: Column, n: Column, rate: float) -> Column:
    """P(at most ``x`` of ``n``) at ``rate``, summed exactly term by term in logarithms.

    Terms from x downwards shrink below the mean, so the sum is scaled by the term at x.
    """
    odds = math.log((1 - rate) / rate)

    def step(acc: Column, k: Column) -> Column:
        # term(k - 1) / term(k), as k runs from x down to 1
        ratio = F.log(k.cast("double")) - F.log((n - k + 1).cast("double")) + odds
        term = acc["term"] + ratio
        return F.struct(term.alias("term"), (acc["sum"] + F.exp(term)).alias("sum"))

    log_choose = F.aggregate(
        F.when(x > 0, F.sequence(F.lit(1).cast("long"), x)).otherwise(F.array().cast("array<bigint>")),
        F.lit(0.0),
        lambda a, k: a + F.log((n - x + k).cast("double")) - F.log(k.cast("double")),
    )
    top = log_choose + x * math.log(rate) + (n - x) * math.log1p(-rate)
    scaled = F.aggregate(
        F.when(x > 0, F.sequence(x, F.lit(1).cast("long"), F.lit(-1).cast("long"))).otherwise(F.array().cast("array<bigint>")),
        F.struct(F.lit(0.0).alias("term"), F.lit(1.0).alias("sum")),
        step,
        lambda a: F.log(a["sum"]),
    )
    return F.when(x >= n, 1.0).when(x > n * rate, 1.0).otherwise(F.least(F.exp(top + scaled), F.lit(1.0)))


def fit(
    measured: DataFrame,
    labels: DataFrame,
    stratum: str = "lang",
    id: str = "doc_id",
    label: str = "quality",
    q: str = "q",
    alpha: float = ALPHA,
    delta: float = DELTA,
) -> DataFrame:
    """(stratum, cutoffs map feature -> largest accepted value) from labelled documents.

    ``measured`` needs ``id``, ``stratum`` and ``q``. Documents that the base rules reject
    take no part.
    """
    good = labels.where(F.col(label) == 1).select(F.col(id).alias("id")).distinct()
    rows = measured.where(~base_failed(q)).select(F.col(id).alias("id"), F.col(stratum).alias("stratum"), q)
    rows = rows.join(good, "id").select(
        F.coalesce(F.concat(F.lit("="), F.col("stratum")), F.lit("null")).alias("stratum"),
        (F.pmod(F.xxhash64("id"), F.lit(FOLDS)) != 0).alias("holdout"),
        _features(q).alias("features"),
    )
    ladder = ladders(rows.where("not holdout"))
    tested = rows.where("holdout").join(ladder, "stratum").select("stratum", "ladder", _rung("features", "ladder").alias("rung"))
    steps = range(len(MULTIPLES) + len(QUANTILES))
    tested = tested.groupBy("stratum", "ladder").agg(
        F.count("*").alias("n"), F.array(*[F.count_if(F.col("rung") <= i) for i in steps]).alias("rejected")
    )
    least = delta / max(1, ladder.count())
    passed = F.transform("rejected", lambda x: binomial_cdf(x, F.col("n"), alpha) <= least)
    climbed = F.aggregate(passed, F.struct(F.lit(0).alias("n"), F.lit(True).alias("on")), _climb, lambda a: a["n"])
    tested = tested.withColumn("climbed", climbed).where("climbed > 0")
    return tested.select("stratum", F.transform_values("ladder", lambda _, cutoffs: F.element_at(cutoffs, F.col("climbed"))).alias("cutoffs"))


def ladders(proposals: DataFrame) -> DataFrame:
    """(stratum, ladder map feature -> cutoffs from loose to strict) of good documents."""
    each = proposals.select("stratum", F.inline("features").alias("name", "value"))
    top, low = F.max("value"), F.percentile_approx("value", list(QUANTILES), 10_000)
    cutoffs = each.groupBy("stratum", "name").agg(F.concat(F.array(*[top * m + SLACK * (m - 1) for m in MULTIPLES]), low).alias("cutoffs"))
    listed = cutoffs.groupBy("stratum").agg(F.map_from_entries(F.collect_list(F.struct("name", "cutoffs"))).alias("ladder"))
    return freeze(listed, "ladders")  # a row per stratum, an entry per feature


def _rung(features: str, ladder: str) -> Column:
    """The place, from 0, of the first rule of the ladder that rejects; cutoffs never rise along it."""
    accepted = F.transform(features, lambda f: F.size(F.filter(F.element_at(ladder, f["name"]), lambda c: f["value"] <= c)))
    return F.array_min(accepted)


def _climb(acc: Column, passes: Column) -> Column:
    on = acc["on"] & passes
    return F.struct(F.when(on, acc["n"] + 1).otherwise(acc["n"]).alias("n"), on.alias("on"))


def judge(measured: DataFrame, cutoffs: DataFrame, stratum: str = "lang", q: str = "q", into: str = "verdict") -> DataFrame:
    """``measured`` with the struct ``into``: base_failed, kept, and what rejects; it replaces a column of that name."""
    kept = [c for c in measured.columns if c.lower() != into.lower()]
    small = cutoffs.limit(MAX_BROADCAST_STRATA + 1).count() <= MAX_BROADCAST_STRATA
    name = F.coalesce(F.concat(F.lit("="), F.col(stratum)), F.lit("null"))
    df = measured.select(F.struct(*[F.col(f"`{c}`") for c in {**dict.fromkeys(kept), q: None}]).alias("row"), name.alias("stratum"))
    # a handful of strata; with very many the planner shuffles and splits hot ones
    df = df.join(F.broadcast(cutoffs) if small else cutoffs, "stratum", "left")
    failed = base_failed(f"row.{q}")
    reasons = F.filter(
        F.transform(
            _features(f"row.{q}"),
            lambda f: F.when(f["value"] > F.try_element_at("cutoffs", f["name"]), f["name"]),
        ),
        lambda x: x.isNotNull(),
    )
    df = df.select("row", failed.alias("base_failed"), F.coalesce(reasons, F.array().cast("array<string>")).alias("reasons"))
    return df.select(
        *[F.col("row").getField(c).alias(c) for c in kept],
        F.struct("base_failed", (~F.col("base_failed") & (F.size("reasons") == 0)).alias("kept"), "reasons").alias(into),
    )
