"""One consistent build of everything that is published."""

from __future__ import annotations

from functools import partial
from typing import NamedTuple

from pyspark.sql import DataFrame

from logtally.operators import drilldown
from logtally.plans import rollup
from logtally.plans.jobs import together
from logtally.plans.series import all_series, meta
from logtally.schema import SERIES_DAYS
from logtally.sources.store import Store


class Snapshot(NamedTuple):
    meta: DataFrame
    series: dict[str, DataFrame]
    counts: DataFrame
    totals: DataFrame
    preview: DataFrame


def _with_drilldown(
    meta_row: DataFrame, series: dict[str, DataFrame], counts: DataFrame
) -> Snapshot:
    return Snapshot(
        meta_row,
        series,
        counts,
        drilldown.drill_totals(counts),
        drilldown.drill_preview(counts),
    )


def staged_snapshot(store: Store, folder: str) -> Snapshot:
    """Everything published, of one commit, from the rollups.

    These take in what is new since the last build; older rows are not read.

    Contributor counts are put down once for details, totals and preview.
    Series and banner row become local frames: 90 rows and one row.
    """
    source, fixed = rollup.refreshed(store)
    spark = store.spark
    series = all_series(source)
    counts = drilldown.drill_counts(source)

    def put() -> DataFrame:
        counts.write.parquet(f"{folder}/counts")
        return spark.read.schema(counts.schema).parquet(f"{folder}/counts")

    written, row, *local = together(
        spark,
        put,
        lambda: _local(_meta(fixed)),
        *[partial(_local, frame) for frame in series.values()],
    )
    return _with_drilldown(row, dict(zip(series, local)), written)


def _meta(store: Store) -> DataFrame:
    dims = store.dims()
    return meta(store.load_log(), store.latest_event(), dims.version, dims.pokemon)


def _local(frame: DataFrame) -> DataFrame:
    """A frame of at most 90 rows, fetched; one row more shows a broken bound."""
    found = frame.limit(SERIES_DAYS + 1).collect()
    return frame.sparkSession.createDataFrame(found, frame.schema)
