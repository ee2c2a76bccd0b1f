"""The ten chart tables of a training run, written as data sets."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame

from tripmill import schema
from tripmill.models.clustering import principal_plane
from tripmill.operators.charts import error_histogram, fare_points, score_bars
from tripmill.operators.metrics import error_by_group
from tripmill.operators.profiling import crosstab_percent, group_means, melt, value_counts
from tripmill.operators.sampling import sample_rows

TOP_FEATURES = 8
POINTS = 1000


def chart_tables(
    scored: DataFrame,
    key: str,
    cluster_columns: Sequence[str],
    importances: DataFrame | None = None,
    comparison: DataFrame | None = None,
) -> dict[str, Callable[[], DataFrame]]:
    """Each table by name, built when asked for; optional parts are left out when absent."""
    category = "predicted_fare_category"
    tables: dict[str, Callable[[], DataFrame]] = {
        "fare_distribution": lambda: value_counts(scored, "fare_category"),
        "fare_vs_distance": lambda: fare_points(scored, key, POINTS),
        "cluster_profiles": lambda: melt(
            group_means(scored, ["cluster"], cluster_columns), ["cluster"], cluster_columns
        ),
        "clusters_pca": lambda: sample_rows(
            principal_plane(scored, cluster_columns, [key, "cluster", "fare_category"]), POINTS, key
        ),
        "fare_category_by_cluster": lambda: melt(
            crosstab_percent(scored, "cluster", "fare_category", schema.FARE_LABELS),
            ["cluster"], schema.FARE_LABELS, "fare_category", "percent",
        ),
        "actual_vs_predicted": lambda: fare_points(scored, key, POINTS, ("fare_amount", "predicted_fare", category)),
        "error_distribution": lambda: error_histogram(scored, "fare_amount", "predicted_fare", category),
        "error_by_distance": lambda: error_by_group(scored, "distance_category", "fare_amount", "predicted_fare"),
    }
    if importances is not None:
        tables["feature_importance"] = lambda: importances.limit(TOP_FEATURES)
    if comparison is not None:
        tables["model_comparison"] = lambda: score_bars(comparison, ["model"], ["mae", "rmse", "r2"])
    return tables


def write_dashboard(
    scored: DataFrame,
    prefix: str,
    key: str,
    cluster_columns: Sequence[str],
    importances: DataFrame | None = None,
    comparison: DataFrame | None = None,
) -> list[str]:
    """Write every table under the prefix; returns the paths written."""
    scored = scored.persist(StorageLevel.MEMORY_AND_DISK)
    written = []
    for name, build in chart_tables(scored, key, cluster_columns, importances, comparison).items():
        path = f"{prefix}/{name}"
        build().write.mode("overwrite").parquet(path)
        written.append(path)
    scored.unpersist()
    return written
