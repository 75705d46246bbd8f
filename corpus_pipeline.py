"""Training-data pipeline over ``documents``: quality, line dedup, near-dedup, decontamination, packing.

Each stage takes (spark, docs, sf_dir), works on everything its predecessor kept and returns
the columns of documents, the last one pieces of packed sequences. Rows without an id, or that
share one, are handled as the operators state it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.llm import containment, lines, neardup, packing, quality
from tallyloom.llm.queries import TOKENIZER, prepare, table
from tallyloom.session import freeze

COPIED = 0.8


def _unused(docs: DataFrame, name: str) -> str:
    """A column name that ``docs`` does not have."""
    taken = {c.lower() for c in docs.columns}
    while name.lower() in taken:
        name += "_"
    return name


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that neither the base rules nor the fitted cutoffs reject."""
    prepare(spark)
    counts, verdict = _unused(docs, "counts"), _unused(docs, "verdict")
    measured = quality.measure(docs, into=counts)
    narrow = freeze(measured.select("doc_id", "lang", counts), "quality")
    cutoffs = freeze(quality.fit(narrow, table(spark, sf_dir, "labels"), q=counts), "cutoffs")
    # measured again instead of joined back, so texts stay where they are
    judged = quality.judge(measured, cutoffs, q=counts, into=verdict)
    return judged.where(F.col(verdict)["kept"]).select(*docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that align with earlier documents.

    A document that loses ``COPIED`` of its words or more is a near copy line by line, and goes: what is
    left of it would be a stub that no later stage could compare with its original.
    """
    into = _unused(docs, "line_dedup")
    done = lines.dedup_lines(docs, into=into).where(~F.col(into)["emptied"] & (F.col(into)["share"] < COPIED))
    if "n_chars" in docs.columns:
        changed = F.when(F.col(into)["n_deleted"] > 0, F.length("text")).otherwise(F.col("n_chars"))
        done = done.withColumn("n_chars", changed.cast(docs.schema["n_chars"].dataType))
    return done.select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the smallest by id, nulls last, then by text hash."""
    found = neardup.near_duplicates(docs).where("node is not null").select("doc_id", "key", "component")
    found = freeze(found, "groups")
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "key")
    first = found.groupBy("component").agg(F.min(place).alias("first"))
    marks = found.groupBy("component", "doc_id", "key").agg(F.count("*").alias("copies")).join(first, "component")
    marks = marks.select(F.col("doc_id").alias("_id"), F.col("key").alias("_key"), (place == F.col("first")).alias("_first"), "copies")
    marks = freeze(marks.where("not _first or copies > 1"), "copies")
    same = docs["doc_id"].eqNullSafe(marks["_id"]) & (F.xxhash64(docs["text"]) == marks["_key"])
    kept = docs.join(marks, same, "left_anti")
    twice = marks.where("_first")
    if twice.isEmpty():
        return kept
    # rows given several times, with one id and text, are combined before the shuffle
    rest = [c for c in docs.columns if c not in ("doc_id", "text")]
    given = docs.join(twice, same, "left_semi").groupBy("doc_id", "text").agg(F.min(F.struct(F.lit(0), *rest)).alias("rest"))
    return kept.unionByName(given.select("doc_id", "text", "rest.*").select(*docs.columns))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item; rows that share an id go by their own text."""
    hits = containment.find_items(docs, table(spark, sf_dir, "benchmark"))
    hits = freeze(hits.select("doc_id", "key").distinct(), "hits")
    same = docs["doc_id"].eqNullSafe(hits["doc_id"]) & (F.xxhash64(docs["text"]) == hits["key"])
    return docs.join(hits, same, "left_anti")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of packed sequences."""
    return packing.pack(docs, TOKENIZER)


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminate),
    ("pack", pack),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written to the shared folder and read again."""
    docs = table(prepare(spark), sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = freeze(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
