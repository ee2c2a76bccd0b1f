"""Clusterings and their quality."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import fixture as fx
from checks.profiles import CLUSTERED
from checks.registry import check, rounded, with_sql
from tripmill.functions import bins
from tripmill.models import clustering, prep
from tripmill.operators import metrics
from tripmill.operators.dbscan import dbscan
from tripmill.operators.features import add_features, add_study_features

SCALED = ["trip_distance", "fare_amount", "passenger_count"]


def _z(column: str, table: str = "trips") -> str:
    return f"({column} - (SELECT avg({column}) FROM {table})) / (SELECT stddev_pop({column}) FROM {table})"


@check("m1_standard_scale", with_sql(fx.TRIPS) + "SELECT trip_key, " + ", ".join(f"round({_z(c)}, 6) AS {c}_z" for c in SCALED) + " FROM trips")
def standard_scale(spark, folder):
    trips = fx.trips(spark, folder)
    return rounded(prep.scale_columns(trips, prep.scaling(trips, SCALED)).select("trip_key", *[f"{c}_z" for c in SCALED]))


M9 = ["trip_distance", "fare_amount", "passenger_count", "pickup_hour"]


@check(
    "m9_clustering_features",
    with_sql(fx.TRIPS, "timed AS (SELECT *, hour(pickup_datetime) AS pickup_hour FROM trips)")
    + "SELECT trip_key, " + ", ".join(f"round({_z(c, 'timed')}, 6) AS {c}_z" for c in M9) + " FROM timed",
)
def clustering_features(spark, folder):
    trips = fx.trips(spark, folder).withColumn("pickup_hour", F.hour("pickup_datetime"))
    return rounded(clustering.scaled_features(trips).select("trip_key", *[f"{c}_z" for c in M9]))


def _clustered(spark, folder):
    return fx.trips(spark, folder).withColumn("cluster", bins.distance_cluster(F.col("trip_distance")))


FEATURES = ["trip_distance", "fare_amount"]


@check(
    "e10_davies_bouldin",
    with_sql(
        fx.TRIPS, CLUSTERED,
        "c AS (SELECT cluster, avg(trip_distance) AS x, avg(fare_amount) AS y FROM clustered GROUP BY 1)",
        "s AS (SELECT c.cluster, any_value(x) AS x, any_value(y) AS y, avg(sqrt((trip_distance - x) ** 2 + (fare_amount - y) ** 2)) AS scatter "
        "FROM clustered t JOIN c ON t.cluster = c.cluster GROUP BY 1)",
        "r AS (SELECT a.cluster, max((a.scatter + b.scatter) / sqrt((a.x - b.x) ** 2 + (a.y - b.y) ** 2)) AS worst FROM s a JOIN s b ON a.cluster <> b.cluster GROUP BY 1)",
    )
    + "SELECT round(avg(worst), 6) AS davies_bouldin FROM r",
)
def davies_bouldin(spark, folder):
    return rounded(metrics.davies_bouldin(_clustered(spark, folder), FEATURES))


@check(
    "e9_silhouette",
    with_sql(
        fx.TRIPS, CLUSTERED,
        "g AS (SELECT cluster AS other, count(*) AS n, sum(trip_distance) AS sx, sum(fare_amount) AS sy, sum(trip_distance ** 2 + fare_amount ** 2) AS sq FROM clustered GROUP BY 1)",
        "numbered AS (SELECT *, row_number() OVER () AS id FROM clustered)",
        "d AS (SELECT id, cluster, other, n, (trip_distance ** 2 + fare_amount ** 2) * n + sq - 2 * (trip_distance * sx + fare_amount * sy) AS total FROM numbered, g)",
        "p AS (SELECT id, cluster, max(CASE WHEN cluster = other THEN total / (n - 1) END) AS a, min(CASE WHEN cluster <> other THEN total / n END) AS b FROM d GROUP BY 1, 2)",
    )
    + "SELECT round(avg((b - a) / greatest(a, b)), 6) AS silhouette FROM p",
)
def silhouette(spark, folder):
    return rounded(metrics.silhouette(_clustered(spark, folder), FEATURES))


def _trips(spark, folder):
    return add_features(fx.trips(spark, folder), "pickup_datetime")


@check("m10_kmeans")
def kmeans(spark, folder):
    found = clustering.fit_clusters(_trips(spark, folder))
    return found.assign(_trips(spark, folder)).select("trip_key", "cluster")


FOUR = ["trip_distance", "fare_amount", "passenger_count", "pickup_hour"]


@check(
    "m10_kmeans_fixed_point",
    with_sql(fx.TRIPS) + "SELECT 3::BIGINT AS clusters, count(*) AS trips, 0::BIGINT AS nearer_elsewhere, 0::BIGINT AS centres_off FROM trips",
)
def kmeans_fixed_point(spark, folder):
    """Trips nearer to another cluster's mean than to their own one's, and centres that are not their cluster's mean."""
    trips = _trips(spark, folder)
    found = clustering.fit_clusters(trips, wanted=FOUR)
    centres = found.model.stages[-1].clusterCenters()
    rows = clustering.scaled_features(found.assign(trips), FOUR).select("cluster", F.array(*[f"{c}_z" for c in FOUR]).alias("x"))
    means = rows.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"), F.array(*[F.avg(F.col("x")[i]) for i in range(len(FOUR))]).alias("mean"))
    packed = F.array_sort(F.collect_list(F.struct("cluster", "mean", "n")))
    far = lambda x, y: F.aggregate(F.zip_with(x, y, lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda s, d: s + d)
    known = F.array(*[F.array(*[F.lit(float(v)) for v in centre]) for centre in centres])
    rows = rows.select("cluster", "x", means.agg(packed).scalar().alias("all"))
    own = F.element_at(F.filter("all", lambda one: one["cluster"] == F.col("cluster")), 1)
    least = F.array_min(F.transform("all", lambda one: far(F.col("x"), one["mean"])))
    off = F.size(F.filter("all", lambda one: far(one["mean"], known[one["cluster"]]) > 1e-9))
    told = rows.select(F.size("all").alias("k"), (far(F.col("x"), own["mean"]) > least + 1e-5).alias("elsewhere"), off.alias("off"))
    return told.agg(
        F.max("k").cast("bigint").alias("clusters"), F.count(F.lit(1)).alias("trips"), F.count_if("elsewhere").alias("nearer_elsewhere"), F.max("off").cast("bigint").alias("centres_off")
    )


@check("m11_cluster_and_describe")
def cluster_and_describe(spark, folder):
    return clustering.fit_clusters(_trips(spark, folder)).statistics


@check("m12_sweep_k")
def sweep_k(spark, folder):
    study = add_study_features(fx.trips(spark, folder))
    return clustering.sweep_clusters(study)


@check("m14_principal_plane")
def principal_plane(spark, folder):
    study = add_study_features(_clustered(spark, folder))
    return clustering.principal_plane(study, ["trip_distance", "fare_amount", "cost_per_mile"], ["trip_key", "cluster", "fare_category"])


DENSE = ["trip_distance", "fare_amount", "cost_per_mile"]
EPS, LEAST = 0.05, 10
OFFSETS = "o AS (SELECT unnest([-1, 0, 1]) AS d)"


@check(
    "m13_dbscan",
    with_sql(
        fx.TRIPS,
        "f AS (SELECT trip_distance, fare_amount, fare_amount / greatest(trip_distance, 0.1::DOUBLE) AS cost_per_mile FROM trips)",
        "z AS (SELECT row_number() OVER () AS id, " + ", ".join(f"{_z(c, 'f')} AS {n}" for c, n in zip(DENSE, "xyw", strict=True)) + " FROM f)",
        f"g AS (SELECT *, floor(x / {EPS})::BIGINT AS i, floor(y / {EPS})::BIGINT AS j, floor(w / {EPS})::BIGINT AS k FROM z)",
        OFFSETS,
        "l AS (SELECT g.*, i + a.d AS ni, j + b.d AS nj, k + c.d AS nk FROM g, o a, o b, o c)",
        "p AS (SELECT l.id AS one, g.id AS two FROM l JOIN g ON ni = g.i AND nj = g.j AND nk = g.k "
        f"WHERE (l.x - g.x) ** 2 + (l.y - g.y) ** 2 + (l.w - g.w) ** 2 <= {EPS * EPS})",
        f"core AS (SELECT one AS id FROM p GROUP BY 1 HAVING count(*) >= {LEAST})",
        "border AS (SELECT DISTINCT one AS id FROM p SEMI JOIN core ON two = core.id ANTI JOIN core c ON one = c.id)",
    )
    + "SELECT CASE WHEN id IN (FROM core) THEN 'core' WHEN id IN (FROM border) THEN 'border' ELSE 'noise' END AS kind, count(*) AS trips FROM z GROUP BY 1",
)
def density_clusters(spark, folder):
    scaled = clustering.scaled_features(add_study_features(fx.trips(spark, folder)), DENSE)
    found = dbscan(scaled, [f"{c}_z" for c in DENSE], EPS, LEAST)
    kind = F.when(F.col("is_core"), "core").when(F.col("cluster") >= 0, "border").otherwise("noise")
    return found.groupBy(kind.alias("kind")).agg(F.count(F.lit(1)).alias("trips"))
