"""Raw landing zone -> warehouse -> exported views."""

from __future__ import annotations

from dataclasses import dataclass
from uuid import uuid4

from pyspark.sql import SparkSession

from offerscope.plans import warehouse
from offerscope.plans.clean import stage_offers, unique_offers
from offerscope.plans.export import export_tables, export_views
from offerscope.plans.views import register
from offerscope.settings import Settings
from offerscope.sources.landing import bad_lines, read_landing, read_marked
from offerscope.sources.places import DEFAULT_PLACES, Places
from offerscope.vocab.labels import SELECTION_LABELS


@dataclass(frozen=True)
class RunSummary:
    dataset_label: str
    n_raw: int
    n_offers: int
    n_offer_skills: int
    exports: dict[str, int]
    n_out_of_scope: int = 0
    n_bad_lines: int = 0


def run(spark: SparkSession, raw_dir: str, warehouse_dir: str, exports_dir: str | None = None,
        settings: Settings = Settings(), places: Places = DEFAULT_PLACES, quarantine_dir: str | None = None,
        processed_dir: str | None = None) -> RunSummary:
    """One full reload.

    The raw text is read once: typed rows go to a staging table while real and demo records are counted on the way.
    What needs the whole set (dataset choice, age limit, deduplication) then reads narrow columns of that table. A load that breaks
    a rule is not published, nor is anything exported or logged.

    A line that is no record ends the run, unless ``quarantine_dir`` names a folder: then such lines are appended there with their
    file, and counted. ``processed_dir`` gets the processed tables as CSV, ``exports_dir`` the views.
    """
    raw = read_marked(spark, raw_dir) if quarantine_dir else read_landing(spark, raw_dir)
    staged = stage_offers(raw, f"{warehouse_dir}/staging/{uuid4().hex}", settings, places)
    if staged.bad_lines:
        bad_lines(raw).write.mode("append").json(quarantine_dir)
    if not staged.real and not staged.demo:
        raise ValueError(f"no raw records below {raw_dir}")

    mode = settings.data_mode
    if mode == "auto":
        mode = "real" if staged.real else "demo"
    n_raw = {"real": staged.real, "demo": staged.demo, "all": staged.real + staged.demo}[mode]
    label = SELECTION_LABELS["both" if mode == "all" and staged.real and staged.demo else
                             "demo" if mode == "demo" or (mode == "all" and not staged.real) else "real"]
    counts = warehouse.store(unique_offers(staged.chosen(mode), settings), warehouse_dir, settings)
    tables = warehouse.load(spark, warehouse_dir)
    warehouse.log_run(spark, warehouse_dir, label, n_raw, counts["offers"], counts["offer_skills"])
    register(tables)
    if processed_dir:
        export_tables(tables, processed_dir)
    exports = export_views(tables, exports_dir) if exports_dir else {}
    return RunSummary(label, n_raw, counts["offers"], counts["offer_skills"], exports, staged.out_of_scope, staged.bad_lines)
