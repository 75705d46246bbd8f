"""Extract files that land in dated folders, and which of them have been taken.

A feed's files lie in ``<root>/day=YYYY-MM-DD/``. What a run has taken is noted under
``<root>/_taken/day=..``, a file per run, by path, size and time of change: a file that is
delivered again in another state counts as new. Both are looked at by day, so a rolling pull
lists and reads the folders of its days only, however long the feed has been running.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.sources.extracts import lookback_start, read_extract, union_fragments

_TAKEN = "path string, size bigint, modified bigint, run string, day date"


@dataclass(frozen=True, order=True)
class Landed:
    """A file as it stands in its day's folder."""

    day: date
    path: str
    size: int
    modified: int


@dataclass(frozen=True)
class Landing:
    spark: SparkSession
    root: str

    def arrived(self, first: date, last: date) -> list[Landed]:
        """All files of some days, in order; folders of other days are not listed."""
        fs, hadoop = self._store()
        out = []
        for n in range((last - first).days + 1):
            day = first + timedelta(days=n)
            for status in fs.globStatus(hadoop.Path(f"{self.root}/day={day}/*")) or []:
                name = status.getPath().getName()
                if status.isFile() and not name.startswith(("_", ".")):
                    out.append(Landed(day, status.getPath().toString(), status.getLen(), status.getModificationTime()))
        return sorted(out)

    def taken(self, first: date, last: date) -> DataFrame:
        """(path, size, modified, run, day) of files of these days that runs have taken."""
        fs, hadoop = self._store()
        if not fs.exists(hadoop.Path(f"{self.root}/_taken")):
            return self.spark.createDataFrame([], _TAKEN)
        rows = self.spark.read.schema(_TAKEN).parquet(f"{self.root}/_taken")
        return rows.where(F.col("day").between(F.lit(first), F.lit(last)))

    def pending(self, first: date, last: date) -> list[Landed]:
        """Files of these days that no run has taken as they are now."""
        known = {(r["path"], r["size"], r["modified"]) for r in self.taken(first, last).collect()}  # files of a few days
        return [f for f in self.arrived(first, last) if (f.path, f.size, f.modified) not in known]

    def read(self, files: Sequence[Landed], sep: str = ",", multiline: bool = True) -> DataFrame:
        """The files as one extract: one scan per header, appended by column name."""
        fs, hadoop = self._store()
        by_header: dict[str, list[str]] = defaultdict(list)
        for file in sorted(files):
            by_header[self._header(fs, hadoop, file.path)].append(file.path)
        return union_fragments([read_extract(self.spark, paths, sep, multiline) for paths in by_header.values()])

    def take(self, files: Sequence[Landed], run: str) -> None:
        """Note that ``run`` has taken the files."""
        rows = [(f.path, f.size, f.modified, run, f.day) for f in files]
        df = self.spark.createDataFrame(rows, _TAKEN).coalesce(1)
        df.write.mode("append").partitionBy("day").parquet(f"{self.root}/_taken")

    def window(self, as_of: datetime, days: int) -> tuple[date, date]:
        """The days of a rolling pull."""
        return lookback_start(as_of, days), as_of.date()

    def _store(self):
        context = self.spark.sparkContext
        hadoop = context._jvm.org.apache.hadoop.fs
        return hadoop.Path(self.root).getFileSystem(context._jsc.hadoopConfiguration()), hadoop

    @staticmethod
    def _header(fs, hadoop, path: str, most: int = 1 << 16) -> str:
        """The first line of a file."""
        stream = fs.open(hadoop.Path(path))
        try:
            return bytes(stream.readNBytes(most)).decode(errors="replace").lstrip("﻿").splitlines()[:1].__str__()
        finally:
            stream.close()

