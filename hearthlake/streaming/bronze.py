from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from hearthlake.params import RunParams
from hearthlake.plans.pipeline import in_scope, load_bronze
from hearthlake.session import Staging
from hearthlake.sources.snapshots import TABLE_COLUMNS, scan_snapshot_table
from hearthlake.sources.tables import Lake


def follow_snapshots(lake: Lake, snapshot_root: str, params: RunParams, checkpoint: str) -> StreamingQuery:
    """Load whatever has landed since the last call, then stop.

    The stream reads only the dates of new snapshot files. Which pages count
    depends on all pages of a date, so each date with news is loaded by the batch
    job. A replayed micro-batch adds nothing: loaded paths are skipped.
    """
    spark = lake.spark

    def load(news: DataFrame, _batch_id: int) -> None:
        with Staging(spark) as stage:
            # At most one row per calendar day.
            for day in sorted(row.file_date for row in news.select("file_date").distinct().collect()):
                snapshots = in_scope(scan_snapshot_table(spark, snapshot_root, day), params)
                load_bronze(lake, snapshots, params, stage, file_date=day)

    landed = spark.readStream.schema(TABLE_COLUMNS).parquet(snapshot_root).select("file_date")
    return (
        landed.writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
