"""The operators applied to whole tables, with SQL equivalents where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.llm import ann, containment, hardneg, lines, neardup, oracles, packing, periodic, pii, quality, secrets, substring, urls, warczip
from tallyloom.session import configure, freeze, scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")

# Rows per Arrow batch: operators cut batches by bytes, this bounds what one batch of very long
# texts, or of their shingle sets, holds.
BATCH_ROWS = "64"


def prepare(spark: SparkSession) -> SparkSession:
    configure(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    return spark


def query(name: str, sql: str | None = None):
    def register(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(prepare(spark), sf_dir)

        run.__name__, run.__doc__ = name, fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op3_quality_rules")
def quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of every document, base verdict, and the verdict of the fitted cutoffs."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    # narrow rows, measured once for the fit and for the verdicts
    measured = freeze(quality.measure(docs).select("doc_id", "lang", "q"), "quality")
    judged = quality.judge(measured, quality.fit(measured, labels))
    return judged.select(
        "doc_id",
        *[F.col(f"q.{c}").alias(c) for c in quality.COUNTS],
        F.col("verdict.base_failed").alias("base_failed"),
        F.col("verdict.kept").alias("kept"),
        F.array_join("verdict.reasons", ",").alias("reasons"),
    )


@query("op4_warc_zip", oracles.WARC)
def warc_zip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written into packages, then read back by ranges."""
    root = scratch_path(spark, "warc")
    written = freeze(warczip.write_packages(table(spark, sf_dir, "pages"), root), "warc-paths")
    records = warczip.read_packages(written, payloads=False)
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query("op8_pii_deobfuscation")
def pii_deobfuscation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of every document."""
    return pii.find_pii(table(spark, sf_dir, "documents"))


@query("op9_secret_entropy")
def secret_entropy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document."""
    return secrets.find_secrets(table(spark, sf_dir, "documents"))


SITES = (
    urls.Rule("org/", urls.ALLOW),
    urls.Rule("example.org/es/", urls.BLOCK),
    urls.Rule("example.org/en/1", urls.BLOCK),
    urls.Rule("com/fr/", urls.ALLOW),
    urls.Rule("com/de/", urls.BLOCK),
)


@query("op10_url_rules", oracles.URLS)
def url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page judged by site rules, then by the default patterns."""
    return urls.judge_urls(table(spark, sf_dir, "pages"), SITES + urls.PATTERNS)


@query("op5_minhash_near_dup", oracles.NEAR)
def minhash_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate class of every document, on lower-cased 4-word shingles."""
    found = neardup.near_duplicates(table(spark, sf_dir, "documents"), k=4, percent=80)
    return found.select("doc_id", "n_shingles", "component_id", "kept")


@query("op2_substring_dedup", oracles.REPEATS)
def substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document that no repeated 35-word window covers."""
    return substring.remove_repeats(table(spark, sf_dir, "documents"), texts_too=False).drop("kept")


@query("op1_benchmark_containment", oracles.LEAKS)
def benchmark_containment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every benchmark item found in every document."""
    return containment.find_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("key")


@query("op6_line_alignment")
def line_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines that every document loses to earlier ones, and a digest of what is left."""
    done = lines.dedup_lines(table(spark, sf_dir, "documents"))
    return done.select("doc_id", "line_dedup.*", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


@query("op7_bm25_packing")
def bm25_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into windows of 2048 tokens."""
    return packing.pack(table(spark, sf_dir, "documents"), TOKENIZER)


def _with_periods(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every tenth document, by the hash of its id, repeats its words from some place on."""
    for batch in batches:
        texts = []
        for text, h in zip(batch["text"], batch["h"].to_pylist(), strict=True):
            words = (text.as_py() or "").encode().split()
            if h is not None and h % 10 == 0 and words:
                g, n = h // 10, len(words)
                a = g % n
                p = 1 + (n - a) // (3 + g % 8)
                words = words[:a] + (words[a : a + p] * (1 + (n - a) // p))[: n - a]
            texts.append(b" ".join(words).decode())
        yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(texts, pa.string())], names=["doc_id", "text"])


@query("op11_periodic_runs")
def find_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of words in every document, the strongest one, and digests."""
    docs = table(spark, sf_dir, "documents")
    docs = docs.select("doc_id", "text", F.crc32(F.col("doc_id").cast("string").cast("binary")).alias("h"))
    docs = docs.mapInArrow(_with_periods, "doc_id long, text string")
    found = periodic.periodic_runs(docs, texts=False)

    def stronger(a, b):
        left, right = a["length"] * b["period"], b["length"] * a["period"]
        tie = F.when(a["start"] != b["start"], F.signum(a["start"] - b["start"])).otherwise(F.signum(a["period"] - b["period"]))
        return F.when(left > right, -1).when(left < right, 1).otherwise(tie.cast("int"))

    listed = F.transform("runs", lambda r: F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")))
    return found.select("doc_id", "n_words", "runs", "collapsed_sha256", F.get(F.array_sort("runs", stronger), 0).alias("best")).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform(listed, lambda x: F.concat(x, F.lit("\n"))), ""), 256).alias("runs_sha256"),
        "collapsed_sha256",
        "n_words",
    )


@query("op12_nearest_vectors")
def nearest_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten nearest rows found for every hundredth vector."""
    return ann.nearest(table(spark, sf_dir, "embeddings"), "id % 100 = 0")


@query("op13_hard_negatives", oracles.HARD)
def hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every hundredth vector; every seventh row's label is changed first."""
    rows = table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hardneg.mine(rows.withColumn("label", label), "id % 100 = 0")
