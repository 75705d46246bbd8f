"""Core and staging tables as Parquet snapshots under one root.

A version is written to a folder of its own, ``<root>/core/<table>/data-<uuid>``, and
published by creating the small file ``<root>/core/<table>/v=<n>`` that names the folder, which
fails if the version exists. So readers never see half a run, a failed run leaves only a
folder that nothing names, and of two runs that overlap one publishes and the other fails,
without a row of it in the table. Staging goes to a folder per attempt; the newest finished
attempt counts, so a run can be repeated under its id.

A version may be laid out in buckets of a key: ``data-<uuid>/__bucket=<b>`` holds the rows
whose key hashes to ``b``, those without a key stand in bucket -1, and the version's file lists
the folder of each bucket. A run that changes rows of a few keys writes the folders of their
buckets and names the other ones as they are. Beside the folders the file keeps the columns,
the largest values of counted columns, and the versions of other tables that the run has read.

Publishing relies on a file system that refuses to create a file twice. HDFS and local disks
do; an object store has to be set to conditional creation. The file is read back, which tells a
run that another one has overwritten it by then, but without that setting not for certain.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom.spec import quoted

BUCKET, KEYLESS = "__bucket", -1
_SCATTER = 64  # parts of the rows without a key
CODEC = "zstd"  # halves digests and identifiers in hex, which the default codec does not


@dataclass(frozen=True)
class Layout:
    """What a version's file says: one folder, or the folders of its buckets."""

    folder: str | None = None
    key: str = ""
    buckets: int = 0
    schema: str = ""
    folders: Mapping[str, str] = field(default_factory=dict)
    tops: Mapping[str, int] = field(default_factory=dict)
    inputs: Mapping[str, int | None] = field(default_factory=dict)

    @classmethod
    def read(cls, text: str) -> Layout:
        return cls(**json.loads(text)) if text.startswith("{") else cls(folder=text)

    def text(self) -> str:
        return self.folder or json.dumps({k: v for k, v in vars(self).items() if k != "folder"})

    def named(self) -> list[str]:
        """All folders of the version, below that of the table."""
        return [self.folder] if self.folder else list(self.folders.values())


def bucket_of(key: str, buckets: int) -> Column:
    """The bucket of a row by its key, whatever the key's type."""
    text = F.col(quoted(key)).cast("string")
    return F.when(text.isNull(), F.lit(KEYLESS)).otherwise(F.pmod(F.xxhash64(text), F.lit(buckets))).cast("int")


@dataclass(frozen=True)
class Store:
    spark: SparkSession
    root: str

    def layout(self, table: str, version: int) -> Layout:
        """What a published version consists of."""
        return Layout.read(_read(self.spark, self._mark(table, version)))

    def staging_path(self, provider: str, table: str, run: str) -> str:
        return f"{self.root}/staging/{provider}/{table}/run={run}"

    def _mark(self, table: str, version: int) -> str:
        return f"{self.root}/core/{table}/v={version}"

    def _publish(self, table: str, version: int, text: str) -> None:
        """Create the version's file; fails if there is one, or if another run's stands there afterwards."""
        _create(self.spark, self._mark(table, version), text)
        if _read(self.spark, self._mark(table, version)) != text:
            raise RuntimeError(f"version {version} of {table} exists: another run has published it")

    def versions(self, table: str) -> list[int]:
        """Published versions, oldest first."""
        found = _glob(self.spark, f"{self.root}/core/{table}/v=*")
        return sorted(int(p.rsplit("/v=", 1)[1]) for p, _ in found)

    def latest(self, table: str) -> int | None:
        """Newest published version."""
        return max(self.versions(table), default=None)

    def read_core(
        self,
        table: str,
        version: int | None = None,
        columns: Sequence[str] | None = None,
        buckets: Iterable[int] | None = None,
    ) -> DataFrame:
        """A published version, the newest by default, or some of its buckets."""
        version = self.latest(table) if version is None else version
        if version is None:
            raise FileNotFoundError(f"core table {table} has no snapshot under {self.root}")
        df = self._rows(table, self.layout(table, version), buckets)
        return df.selectExpr(*map(quoted, columns)) if columns else df

    def _rows(self, table: str, layout: Layout, buckets: Iterable[int] | None = None) -> DataFrame:
        top = f"{self.root}/core/{table}"
        if layout.folder:
            return self.spark.read.parquet(f"{top}/{layout.folder}")
        wanted = None if buckets is None else {str(b) for b in buckets}
        paths = [f"{top}/{f}" for b, f in sorted(layout.folders.items()) if wanted is None or b in wanted]
        schema = T.StructType.fromJson(json.loads(layout.schema))
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def changed_rows(self, table: str, old: int, new: int, columns: Sequence[str]) -> DataFrame:
        """Distinct ``columns`` of rows that only one of two versions has, from the buckets that differ."""
        before, after = self.layout(table, old), self.layout(table, new)
        buckets: list[set[int] | None] = [None, None]
        if before.folders and after.folders and (before.key, before.buckets) == (after.key, after.buckets):
            differ = {b for b in {*before.folders, *after.folders} if before.folders.get(b) != after.folders.get(b)}
            buckets = [{int(b) for b in differ}] * 2
        sides = []
        for layout, chosen, sign in ((before, buckets[0], -1), (after, buckets[1], 1)):
            rows = self._rows(table, layout, chosen)
            listed = [F.col(quoted(c)) if c in rows.columns else F.lit(None).alias(c) for c in columns]
            sides.append(rows.select(*listed, F.lit(sign).alias("__sign")))
        counted = sides[0].union(sides[1]).groupBy(*[F.col(quoted(c)) for c in columns]).agg(F.sum("__sign").alias("__more"))
        return counted.where("__more != 0").drop("__more")

    def has_core(self, table: str) -> bool:
        return self.latest(table) is not None

    def write_core(self, table: str, df: DataFrame, after: int | None = None) -> int:
        """Write the version after ``after``, the one the caller has read, and publish it.

        Fails, with the table as it was, if that version has been published meanwhile.
        """
        version = 0 if after is None else after + 1
        folder = f"data-{uuid.uuid4().hex}"
        path = f"{self.root}/core/{table}/{folder}"
        try:
            df.write.mode("errorifexists").option("compression", CODEC).parquet(path)
            self._publish(table, version, folder)
        except BaseException:
            _delete(self.spark, path)
            raise
        return version

    def write_buckets(
        self,
        table: str,
        df: DataFrame,
        key: str,
        buckets: int,
        after: int | None = None,
        touched: Iterable[int] | None = None,
        tops: Sequence[str] = (),
        inputs: Mapping[str, int | None] | None = None,
    ) -> int:
        """Write the version after ``after`` in buckets of ``key``, and publish it.

        ``df`` holds all rows of the ``touched`` buckets, by default of all. The other ones
        are taken from version ``after``, which must have the same layout. The largest values
        of the columns ``tops`` are carried from version to version.
        """
        version = 0 if after is None else after + 1
        base = Layout() if after is None else self.layout(table, after)
        if touched is not None and (base.key, base.buckets) != (key, buckets):
            raise ValueError(f"version {after} of {table} has no {buckets} buckets of {key}")
        folder = f"data-{uuid.uuid4().hex}"
        path = f"{self.root}/core/{table}/{folder}"
        seen = Observation(f"tops-{folder}")
        found = [F.count(F.lit(1)).alias("__rows"), *[F.max(F.col(quoted(c))).alias(c) for c in tops]]
        scatter = F.when(F.col(BUCKET) == KEYLESS, F.pmod(F.xxhash64(*map(quoted, df.columns)), F.lit(_SCATTER))).otherwise(0)
        rows = df.withColumn(BUCKET, bucket_of(key, buckets)).repartition(F.col(BUCKET), scatter)
        try:
            rows.observe(seen, *found).write.mode("errorifexists").option("compression", CODEC).partitionBy(BUCKET).parquet(path)
            written = [p for p, _ in _glob(self.spark, f"{path}/{BUCKET}=*")]
            folders = {p.rsplit("=", 1)[1]: f"{folder}/{p.rsplit('/', 1)[1]}" for p in written}
            keep: dict[str, str] = {}
            schema = df.schema
            if touched is not None:
                replaced = {str(b) for b in touched}
                if not folders.keys() <= replaced:
                    raise ValueError(f"rows outside the touched buckets of {table}: {sorted(folders.keys() - replaced)}")
                keep = {b: f for b, f in base.folders.items() if b not in replaced}
                old = T.StructType.fromJson(json.loads(base.schema))
                schema = T.StructType([*schema, *[f for f in old if f.name not in schema.names]])
            largest = dict(base.tops) if touched is not None else {}
            for c in tops:
                if seen.get[c] is not None:
                    largest[c] = max(int(seen.get[c]), largest.get(c, int(seen.get[c])))
            layout = Layout(None, key, buckets, schema.json(), {**keep, **folders}, largest, dict(inputs or {}))
            self._publish(table, version, layout.text())
        except BaseException:
            _delete(self.spark, path)
            raise
        return version

    def expire(self, table: str, keep: int = 2) -> list[int]:
        """Drop all but the newest ``keep`` versions; returns what was dropped.

        Folders that a kept version names as well stay.
        """
        versions = self.versions(table)
        old, kept = versions[: -max(keep, 1)], versions[-max(keep, 1) :]
        used = {f for v in kept for f in self.layout(table, v).named()}
        tops = {f.split("/")[0] for f in used}
        for version in old:
            gone = set(self.layout(table, version).named()) - used
            _delete(self.spark, self._mark(table, version))
            # a folder of a run goes as a whole once no bucket of it is named
            for name in {f if f.split("/")[0] in tops else f.split("/")[0] for f in gone}:
                _delete(self.spark, f"{self.root}/core/{table}/{name}")
        return old

    def expire_staging(self, provider: str, table: str, keep: int = 2) -> int:
        """Drop all finished staging attempts but the newest ``keep``; returns their number."""
        found = sorted((t, p.rsplit("/", 1)[0]) for p, t in self._staged(provider, table))
        old = [path for _, path in found[: -max(keep, 1)]]
        for path in old:
            _delete(self.spark, path)
        return len(old)

    def orphans(self, table: str, older_than_ms: int) -> list[str]:
        """Folders that no version names, last changed before that time; drop them with ``drop``."""
        named = {f.split("/")[0] for v in self.versions(table) for f in self.layout(table, v).named()}
        found = _glob(self.spark, f"{self.root}/core/{table}/data-*")
        return [p for p, t in found if t < older_than_ms and p.rsplit("/", 1)[1] not in named]

    def drop(self, paths: Sequence[str]) -> None:
        for path in paths:
            _delete(self.spark, path)

    def _staged(self, provider: str, table: str) -> list[tuple[str, int]]:
        return _glob(self.spark, f"{self.root}/staging/{provider}/{table}/run=*/attempt=*/_SUCCESS")

    def latest_staging(self, provider: str, table: str) -> str | None:
        """Path of the staging run that was finished last."""
        runs = [(finished, p.rsplit("/", 1)[0]) for p, finished in self._staged(provider, table)]
        return max(runs)[1] if runs else None

    def write_staging(self, provider: str, table: str, run: str, df: DataFrame) -> DataFrame:
        """Stage a run and read it back without the columns that are wholly null.

        Non-null cells are counted while the rows are written, so dropping the
        empty columns costs no pass of its own.
        """
        seen = Observation(f"staged-{provider}-{table}-{run}")
        counts = [F.expr(f"count({quoted(c)}) AS {quoted(c)}") for c in df.columns]
        path = f"{self.staging_path(provider, table, run)}/attempt={uuid.uuid4().hex}"
        df.observe(seen, *counts).write.mode("errorifexists").parquet(path)
        filled = [c for c in df.columns if seen.get[c] > 0]
        return self.spark.read.schema(df.schema).parquet(path).selectExpr(*map(quoted, filled))

    def complete(self, path: str) -> bool:
        return bool(_glob(self.spark, f"{path}/_SUCCESS"))

    def mark(self, path: str) -> None:
        """Note, beside a written table, that what follows its writing has been done."""
        _create(self.spark, f"{path}.done", "")

    def marked(self, path: str) -> bool:
        return bool(_glob(self.spark, f"{path}.done"))

    def refused_path(self, provider: str, table: str, run: str) -> str:
        return f"{self.root}/refused/{provider}/{table}/run={run}"

    def append_log(self, name: str, df: DataFrame) -> None:
        df.coalesce(1).write.mode("append").parquet(f"{self.root}/log/{name}")

    def read_log(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/log/{name}")


def _glob(spark: SparkSession, pattern: str) -> list[tuple[str, int]]:
    """Paths that match, with their times, on whatever file system the root lies."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(pattern)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return [(s.getPath().toString(), s.getModificationTime()) for s in (fs.globStatus(path) or [])]


def _delete(spark: SparkSession, name: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(name)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def _file(spark: SparkSession, name: str):
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(name)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), path


def _create(spark: SparkSession, name: str, text: str) -> None:
    """A new small file; fails if there is one."""
    fs, path = _file(spark, name)
    out = fs.create(path, False)
    out.write(bytearray(text.encode()))
    out.close()


def _read(spark: SparkSession, name: str) -> str:
    fs, path = _file(spark, name)
    stream = fs.open(path)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()
