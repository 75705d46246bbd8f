"""The same reconciliation as an incremental stream over a landing folder.

Late rows need no watermark: the business key decides where a row goes, and no
state is kept between batches but the core itself.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tallyloom.plans.table_run import Workspace, run_table
from tallyloom.spec import Provider


def read_landing(
    spark: SparkSession,
    folder: str,
    header: list[str],
    sep: str = ",",
    max_files: int | None = None,
) -> DataFrame:
    """CSV files as they land, every column text."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in header])
    reader = (
        spark.readStream.schema(schema)
        .option("header", True)
        .option("sep", sep)
        .option("multiLine", True)
        .option("quote", '"')
        .option("escape", '"')
    )
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.csv(folder)


def stream_batches(
    rows: DataFrame, apply: Callable[[DataFrame, int], None], checkpoint: str
) -> StreamingQuery:
    """Work off all that has landed, batch by batch, then stop.

    ``apply`` may see a batch again after a failure, with the same number.
    """
    return (
        rows.writeStream.trigger(availableNow=True)
        .option("checkpointLocation", checkpoint)
        .foreachBatch(apply)
        .start()
    )


def stream_upsert(
    ws: Workspace,
    provider: Provider,
    table: str,
    rows: DataFrame,
    as_of: datetime,
    checkpoint: str,
    stream: str,
) -> StreamingQuery:
    """Run the table once per batch of landed files.

    A batch is marked as applied after its snapshot is written. One that is
    replayed after its mark is skipped; one replayed before it is reconciled
    again, which changes nothing but ``change_timestamp``.
    """

    def apply(batch: DataFrame, number: int) -> None:
        mark = f"{ws.store.root}/log/streams/{stream}/batch={number}"
        if ws.store.complete(mark):
            return
        spark = batch.sparkSession
        done = run_table(ws, provider, table, batch, as_of, f"{stream}-{number:010d}")
        if done.status == "failed":
            raise RuntimeError(done.message)
        spark.createDataFrame([(number, done.status)], "batch bigint, status string").coalesce(
            1
        ).write.mode("overwrite").parquet(mark)

    return stream_batches(rows, apply, checkpoint)
