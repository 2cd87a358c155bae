"""Viewing curves on a percent scale, their clusters and medians.

After resampling a video has at most 101 rows (0 to 100 percent), so windows
and arrays per video are small from there on.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from streamgauge.functions.numbers import percent_bucket
from streamgauge.operators.clusters import assign_clusters, best_centers
from streamgauge.operators.medians import exact_median
from streamgauge.operators.series import attach_group
from streamgauge.session import materialize

PERCENTS = list(range(101))
# Names of the four curve clusters.
CLUSTER_NAMES = ["Mid-Peak Drop", "Mid-Peak Stable", "Irregular", "Early-Rise Stable"]


def percent_resample(minutes: DataFrame) -> DataFrame:
    """Mean of average and maximum of peak viewers per whole percent of the stream.

    All versions of a minute count, as in the satellite; they are folded per
    position before anything is shuffled. Text that is no number counts as NULL.
    """
    number = {c: F.expr(f"try_cast({c} AS DOUBLE)") for c in ("average_concurrent_viewers", "peak_concurrent_viewers")}
    folded = minutes.groupBy("video_id", "livestream_position").agg(
        F.sum(number["average_concurrent_viewers"]).alias("_sum"),
        F.count(number["average_concurrent_viewers"]).alias("_n"),
        F.max(number["peak_concurrent_viewers"]).alias("_peak"),
    )
    longest = {"_longest": ("max", "livestream_position")}
    placed = attach_group(folded, ["video_id"], "livestream_position", longest, source=minutes)
    percent = percent_bucket(F.col("livestream_position"), F.col("_longest"))
    return (
        placed.withColumn("pct", percent)
        .filter(F.col("pct").isNotNull())
        .groupBy("video_id", "pct")
        .agg(
            F.try_divide(F.sum("_sum"), F.sum("_n")).alias("average_concurrent_viewers"),
            F.max("_peak").alias("peak_concurrent_viewers"),
        )
    )


def curve_matrix(resampled: DataFrame) -> DataFrame:
    """One row per video, one column ``pct_0`` .. ``pct_100`` of average viewers."""
    rows = resampled.filter(F.col("average_concurrent_viewers").isNotNull())
    wide = rows.groupBy("video_id").pivot("pct", PERCENTS).agg(F.avg("average_concurrent_viewers"))
    return wide.withColumnsRenamed({str(p): f"pct_{p}" for p in PERCENTS})


def interpolate(points: DataFrame, keys, index: str, value: str, out: str) -> DataFrame:
    """Fill NULLs between neighbours by equal steps.

    A gap at the end takes the last value, one at the start stays NULL.
    """
    w = Window.partitionBy(*keys).orderBy(index)
    back, ahead = w.rowsBetween(Window.unboundedPreceding, 0), w.rowsBetween(0, Window.unboundedFollowing)
    at = F.when(F.col(value).isNotNull(), F.col(index))
    rows = points.withColumns(
        {
            "_v0": F.last(value, ignorenulls=True).over(back),
            "_i0": F.last(at, ignorenulls=True).over(back),
            "_v1": F.first(value, ignorenulls=True).over(ahead),
            "_i1": F.first(at, ignorenulls=True).over(ahead),
        }
    )
    step = F.try_divide(F.col("_v1") - F.col("_v0"), F.col("_i1") - F.col("_i0"))
    line = F.col("_v0") + step * (F.col(index) - F.col("_i0"))
    return rows.withColumn(out, F.coalesce(F.col(value), line, F.col("_v0"))).drop("_v0", "_i0", "_v1", "_i1")


def fill_curves(resampled: DataFrame) -> DataFrame:
    """Every video on the grid of percents that occur in any video, gaps filled.

    Steps count grid places, not percents. Videos without any value are absent.
    """
    known = resampled.filter(F.col("average_concurrent_viewers").isNotNull())
    grid = known.agg(F.array_sort(F.collect_set("pct"))).scalar()
    points = F.map_from_entries(F.collect_list(F.struct("pct", "average_concurrent_viewers")))
    curves = known.groupBy("video_id").agg(points.alias("_points")).withColumn("_grid", grid)
    rows = curves.select("video_id", "_points", F.posexplode("_grid").alias("_place", "pct"))
    rows = rows.withColumn("_value", F.try_element_at("_points", F.col("pct"))).drop("_points")
    filled = interpolate(rows, ["video_id"], "_place", "_value", "average_concurrent_viewers")
    return filled.select("video_id", "pct", "average_concurrent_viewers")


def normalise_curves(filled: DataFrame, dim_video: DataFrame, min_avg: float = 10, video_type: str = "Livestream") -> DataFrame:
    """Curves of one video type with a mean above ``min_avg``, scaled to 0..1; flat ones are 0."""
    live = dim_video.filter(F.col("video_type") == video_type).select("video_id", "video_title")
    video = Window.partitionBy("video_id")
    viewers = F.col("average_concurrent_viewers")
    rows = (
        filled.join(live, "video_id")
        .withColumns(
            {
                "avg_viewers": F.avg(viewers).over(video),
                "_low": F.min(viewers).over(video),
                "_high": F.max(viewers).over(video),
            }
        )
        .filter(F.col("avg_viewers") > min_avg)
    )
    scaled = F.try_divide(viewers - F.col("_low"), F.col("_high") - F.col("_low"))
    flat = viewers.isNotNull() & (F.col("_high") == F.col("_low"))
    return rows.withColumn("norm", F.when(flat, 0.0).otherwise(scaled)).drop("_low", "_high")


def curve_vectors(norm: DataFrame) -> DataFrame:
    """One vector per video in percent order; a leading gap takes the first value."""
    ordered = F.array_sort(F.collect_list(F.struct("pct", "norm")))
    values = F.transform("_points", lambda p: p["norm"])
    first = F.get(F.filter("_values", lambda v: v.isNotNull()), F.lit(0))
    return (
        norm.groupBy("video_id")
        .agg(ordered.alias("_points"))
        .withColumn("_values", values)
        .select("video_id", F.transform("_values", lambda v: F.coalesce(v, first)).alias("curve"))
    )


def _shape(center) -> dict[str, float]:
    q = max(len(center) // 4, 1)
    mean = lambda xs: sum(xs) / max(len(xs), 1)
    steps = [abs(b - a) for a, b in zip(center[:-1], center[1:])]
    mid, late = mean(center[q:-q]), mean(center[-q:])
    return {"rough": mean(steps), "early": mean(center[:q]), "drop": mid - late}


def name_clusters(centers) -> dict[int, str]:
    """Names by the shape of the centres, so they do not depend on cluster numbers.

    The roughest curve is irregular, the one that starts highest rises early,
    and of the other two the one that falls more towards the end drops.
    """
    if len(centers) != len(CLUSTER_NAMES):
        return {i: f"Cluster {i}" for i in range(len(centers))}
    shapes = {i: _shape([float(x) for x in c]) for i, c in enumerate(centers)}
    named = {}
    for name, trait in (("Irregular", "rough"), ("Early-Rise Stable", "early"), ("Mid-Peak Drop", "drop")):
        best = max(shapes, key=lambda i: (shapes[i][trait], -i))
        named[best] = name
        del shapes[best]
    named[next(iter(shapes))] = "Mid-Peak Stable"
    return named


def cluster_curves(norm: DataFrame, k: int = 4, restarts: int = 20, seed: int = 42, max_iter: int = 20) -> DataFrame:
    """k-means over whole curves; the best of ``restarts`` starts names each video's cluster.

    All starts move together: a step is one scan that assigns every curve to its
    centre in each start and adds up the new centres.
    """
    vectors = materialize(curve_vectors(norm), "curve_vectors")
    centers = best_centers(vectors, "video_id", "curve", k, restarts, seed, max_iter)
    names = name_clusters(centers)
    label = F.create_map(*[x for i, n in names.items() for x in (F.lit(i), F.lit(n))]) if names else F.lit(None).cast("map<int,string>")
    return assign_clusters(vectors, "curve", centers, "_cluster").select("video_id", label[F.col("_cluster")].alias("cluster"))


def cluster_medians(curves: DataFrame, clusters: DataFrame) -> DataFrame:
    """Median viewers per percent and cluster."""
    rows = curves.join(clusters, "video_id")
    return exact_median(rows, ["cluster", "pct"], "average_concurrent_viewers", "average_viewers")


def cluster_members(curves: DataFrame, clusters: DataFrame, name) -> DataFrame:
    """Curves of all videos of one cluster."""
    chosen = clusters.filter(F.col("cluster") == name).select("video_id")
    return curves.join(chosen, "video_id", "left_semi")
