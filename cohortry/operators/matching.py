"""1:1 nearest matching on the logit score, as a distributed two-sided as-of join."""

from __future__ import annotations

from math import ceil

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window, functions as F

from ..scale import stage
from .propensity import TREATMENT

# Fixed value: caliper as a multiple of the logit's deviation.
CALIPER = 0.2

ROWS_PER_BUCKET = 100_000


def caliper_width(scored: DataFrame, multiplier: float = CALIPER) -> float:
    """``multiplier`` times the population deviation of the logit over both arms."""
    return multiplier * (scored.agg(F.stddev_pop("logit_ps")).first()[0] or 0.0)


def score_nodes(scored: DataFrame) -> DataFrame:
    """One row per distinct logit and arm, with the lowest person id.

    Among people with equal scores only the lowest id can be part of a pair: equal controls are
    resolved to the lowest id, and equal users all want the same control, which the lowest takes.
    Grouping combines on the map side, so a score shared by very many people costs nothing.
    """
    return scored.groupBy("logit_ps", TREATMENT).agg(F.min("person_id").alias("person_id"))


def _with_buckets(nodes: DataFrame, rows_per_bucket: int) -> DataFrame:
    """Ranges of the logit with about equal numbers of nodes."""
    wanted = ceil(nodes.count() / rows_per_bucket)
    splits: list[float] = []
    if wanted > 1:
        shares = [i / wanted for i in range(1, wanted)]
        splits = sorted(set(nodes.approxQuantile("logit_ps", shares, 0.1 / wanted)))
    if not splits:
        return nodes.withColumn("bucket", F.lit(0.0))
    edges = [float("-inf"), *splits, float("inf")]
    return Bucketizer(splits=edges, inputCol="logit_ps", outputCol="bucket").transform(nodes)


def _edge_controls(nodes: DataFrame) -> DataFrame:
    """For each bucket the nearest controls of the buckets before and after it, as control rows.

    One row per bucket is windowed here, about one per ``ROWS_PER_BUCKET`` people.
    """
    control = F.when(F.col(TREATMENT) == 0, F.struct("logit_ps", "person_id"))
    # The lowest id of a logit is already chosen, so the order of the struct is that of the logit.
    per_bucket = nodes.groupBy("bucket").agg(F.min(control).alias("first"), F.max(control).alias("last"))
    before = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    after = Window.orderBy("bucket").rowsBetween(1, Window.unboundedFollowing)
    neighbours = per_bucket.select(
        "bucket",
        F.last("last", ignorenulls=True).over(before).alias("previous"),
        F.first("first", ignorenulls=True).over(after).alias("next"),
    )
    return (
        neighbours.select("bucket", F.explode(F.array("previous", "next")).alias("control"))
        .filter(F.col("control").isNotNull())
        .select("bucket", "control.logit_ps", F.lit(0).alias(TREATMENT), "control.person_id")
    )


def nearest_nodes(scored: DataFrame, rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """Nearest control of every distinct user logit: ``logit_ps, user_id, control_id, distance``.

    Equal distances below and above go to the lower control id. Each bucket is sorted and scanned
    once in either direction, which is linear in its rows.
    """
    nodes = stage(score_nodes(scored))
    bucketed = _with_buckets(nodes, rows_per_bucket).select("bucket", "logit_ps", TREATMENT, "person_id")
    both = bucketed.unionByName(_edge_controls(bucketed))
    control = F.when(F.col(TREATMENT) == 0, F.struct("logit_ps", "person_id"))
    upward = Window.partitionBy("bucket").orderBy("logit_ps", TREATMENT)
    downward = Window.partitionBy("bucket").orderBy(F.desc("logit_ps"), TREATMENT)
    rows = (Window.unboundedPreceding, Window.currentRow)

    def candidate(side: str):
        gap = F.abs(F.col("logit_ps") - F.col(f"{side}.logit_ps"))
        return F.when(F.col(side).isNotNull(), F.struct(gap.alias("distance"), F.col(f"{side}.person_id").alias("id")))

    return (
        both.withColumn("below", F.last(control, ignorenulls=True).over(upward.rowsBetween(*rows)))
        .withColumn("above", F.last(control, ignorenulls=True).over(downward.rowsBetween(*rows)))
        .filter(F.col(TREATMENT) == 1)
        .select("logit_ps", "person_id", F.least(candidate("below"), candidate("above")).alias("best"))
        .filter(F.col("best").isNotNull())
        .select(
            "logit_ps",
            F.col("person_id").alias("user_id"),
            F.col("best.id").alias("control_id"),
            F.col("best.distance").alias("distance"),
        )
    )


def nearest_controls(scored: DataFrame, rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """Nearest control of every user, including users with equal scores."""
    near = nearest_nodes(scored, rows_per_bucket).drop("user_id")
    people = scored.filter(F.col(TREATMENT) == 1).select("logit_ps", F.col("person_id").alias("user_person_id"))
    return people.join(near, "logit_ps").select(
        "user_person_id", F.col("control_id").alias("nonuser_person_id"), F.col("distance").alias("ps_distance")
    )


def match_pairs(scored: DataFrame, caliper: float | None = None, rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """Accepted pairs.

    Users choose in ascending id; a user whose nearest control is taken stays unmatched. So each
    control within the caliper simply goes to the lowest user id that wants it.
    """
    width = caliper_width(scored) if caliper is None else caliper
    near = nearest_nodes(scored, rows_per_bucket).filter(F.col("distance") <= width)
    winner = F.min(F.struct("user_id", "distance")).alias("winner")
    return near.groupBy("control_id").agg(winner).select(
        F.col("winner.user_id").alias("user_person_id"),
        F.col("control_id").alias("nonuser_person_id"),
        F.col("winner.distance").alias("ps_distance"),
    )


def matched_people(scored: DataFrame, pairs: DataFrame) -> DataFrame:
    """Rows of both arms that are part of a pair."""
    ids = pairs.select(F.explode(F.array("user_person_id", "nonuser_person_id")).alias("person_id"))
    return scored.join(ids, "person_id", "left_semi")


def match_rate(scored: DataFrame, pairs: DataFrame) -> DataFrame:
    """Users, pairs and the share of users matched, as one row."""
    counts = scored.filter(F.col(TREATMENT) == 1).select(F.lit(1).alias("users"), F.lit(0).alias("pairs")).unionAll(
        pairs.select(F.lit(0), F.lit(1))
    )
    return counts.agg(
        F.coalesce(F.sum("users"), F.lit(0)).alias("n_users"), F.coalesce(F.sum("pairs"), F.lit(0)).alias("n_pairs")
    ).withColumn("match_rate", F.try_divide(F.col("n_pairs").cast("double"), F.col("n_users")))
