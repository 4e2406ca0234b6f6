"""Weekly accumulation as a stream: each landed file is cleaned once.

Cleaning is stateless, so new files go through ``typed_offers`` and are appended to a staging table with their
arrival key. What compares rows with each other (age limit, deduplication, views) runs in batch over the staging
table: the oldest date wins, and a late file may bring an older one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from offerscope import schemas
from offerscope.operators.filters import select_dataset
from offerscope.operators.skew import spread
from offerscope.plans.clean import staged_columns, typed_offers, unique_offers
from offerscope.settings import Settings
from offerscope.sources.places import DEFAULT_PLACES, Places


def start(spark: SparkSession, raw_dir: str, staging_dir: str, checkpoint_dir: str,
          settings: Settings = Settings(), places: Places = DEFAULT_PLACES,
          max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Processes what has landed since the last run, then stops.

    A line that is not a record ends the run, as it does in `read_landing`; it is never taken for an empty record.
    A batch replayed after a failure overwrites its own folder, so no record is staged twice.
    """
    reader = (spark.readStream.schema(schemas.RAW).option("mode", "FAILFAST").option("recursiveFileLookup", True)
              .option("pathGlobFilter", "*.json*"))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    landed = reader.json(raw_dir).select("*", "_metadata.file_name", "_metadata.file_path",
                                         "_metadata.file_block_start")

    def stage(batch: DataFrame, batch_id: int) -> None:
        typed = typed_offers(spread(_arrival_of(batch), ["_file", "_line"]), settings, places).select(*staged_columns())
        typed.write.mode("overwrite").parquet(f"{staging_dir}/batch={batch_id}")

    return (landed.writeStream.foreachBatch(stage).option("checkpointLocation", checkpoint_dir)
            .trigger(availableNow=True).start())


def _arrival_of(batch: DataFrame) -> DataFrame:
    return batch.withColumnsRenamed({"file_name": "_raw_file", "file_path": "_file", "file_block_start": "_block"}) \
        .withColumn("_line", F.monotonically_increasing_id())


def staged_offers(spark: SparkSession, staging_dir: str) -> DataFrame:
    return spark.read.parquet(staging_dir).drop("batch")


def unique_staged(spark: SparkSession, staging_dir: str, settings: Settings = Settings()) -> DataFrame:
    """Clean table over everything staged so far; pass it to ``warehouse.store``."""
    return unique_offers(select_dataset(staged_offers(spark, staging_dir), settings.data_mode), settings)
