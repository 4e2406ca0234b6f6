"""CSV export of the views."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.types import StructType

from offerscope.plans.views import FACT_VIEWS, VIEWS
from offerscope.plans.warehouse import Warehouse


def write_csv(df: DataFrame, path: str, single_file: bool = False) -> int:
    """Header, UTF-8, ISO dates, decimal point; returns the row count observed while writing."""
    seen = Observation()
    counted = df.observe(seen, F.count(F.lit(1)).alias("rows"))
    if single_file:
        counted = counted.coalesce(1)
    counted.write.mode("overwrite").option("header", True).option("dateFormat", "yyyy-MM-dd").option("escape", '"').csv(path)
    return seen.get["rows"]


def export_views(w: Warehouse, out_dir: str, names: Iterable[str] = tuple(VIEWS)) -> dict[str, int]:
    """Writes ``<out_dir>/<name>.csv`` for each view. Fact-sized views stay split in part files."""
    return {name: write_csv(VIEWS[name](w), f"{out_dir}/{name}.csv", single_file=name not in FACT_VIEWS)
            for name in names}


def export_tables(w: Warehouse, out_dir: str) -> dict[str, int]:
    """Writes the processed tables, offers and their skills, as CSV in several parts; texts keep their line breaks inside quotes."""
    return {name: write_csv(getattr(w, name), f"{out_dir}/{name}.csv") for name in ("offers", "offer_skills")}


def read_csv(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """A table that ``write_csv`` wrote."""
    return spark.read.schema(schema).option("header", True).option("multiLine", True).option("escape", '"').csv(path)
