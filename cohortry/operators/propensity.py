"""Feature preparation and propensity scores over both arms."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..scale import local_frame, stage

TREATMENT = "treatment"

# Scores are kept inside these bounds before the logit.
CLIP_LOW, CLIP_HIGH = 0.001, 0.999

# The sketch brackets each median within this share of the ranks; see ``medians``.
SKETCH_ACCURACY = 10_000
BRACKET = 5 / SKETCH_ACCURACY
GRID = 500
WINDOW_ROWS = 1_000_000


def combine_arms(users: DataFrame, non_users: DataFrame) -> DataFrame:
    """Both arms with ``treatment`` 1 and 0; columns of one arm only become null in the other."""
    return users.withColumn(TREATMENT, F.lit(1)).unionByName(
        non_users.withColumn(TREATMENT, F.lit(0)), allowMissingColumns=True
    )


def available(df: DataFrame, features: Sequence[str]) -> list[str]:
    return [f for f in features if f in df.columns]


def _text_columns(df: DataFrame, features: Sequence[str]) -> list[str]:
    kinds = dict(df.dtypes)
    return [f for f in features if kinds[f] == "string"]


def distinct_labels(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Staged ``(feature, label)`` of text columns: one pass over the rows, and far fewer rows after it."""
    long = df.select(*columns).unpivot([], list(columns), "feature", "label")
    return stage(long.filter("label IS NOT NULL").distinct())


def numeric_text(labels: DataFrame) -> list[str]:
    """Features all of whose labels read as numbers."""
    unreadable = labels.groupBy("feature").agg(F.count_if(F.col("label").try_cast("double").isNull()).alias("n"))
    return [r.feature for r in unreadable.filter("n = 0").collect()]


def _positions(labels: DataFrame) -> DataFrame:
    """``code``: position from 0 of each label among its feature's sorted labels.

    Labels are cut into ranges, staged with their range number. Each range is ranked on its own and
    moved up by the labels in the ranges before it.
    """
    by_feature = Window.partitionBy("feature")
    ranges = stage(labels.repartitionByRange("feature", "label").withColumn("part", F.spark_partition_id()))
    before = by_feature.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = ranges.groupBy("feature", "part").agg(F.count(F.lit(1)).alias("rows")).select(
        "feature", "part", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("offset")
    )
    within = F.row_number().over(Window.partitionBy("feature", "part").orderBy("label")) - 1
    return ranges.withColumn("position", within).join(offsets, ["feature", "part"]).select(
        "feature", "label", (F.col("position") + F.col("offset")).alias("code")
    )


def encode_labels(df: DataFrame, columns: Sequence[str], labels: DataFrame | None = None) -> DataFrame:
    """Text replaced by its position, from 0, in the sorted distinct values; null stays null.

    Labels are ranked, never the rows. Few labels go back by broadcast, which a dominating label
    does not skew, very many by a shuffle join.
    """
    if not columns:
        return df
    labels = distinct_labels(df, columns) if labels is None else labels
    ranked = _positions(labels.filter(F.col("feature").isin(list(columns))))
    out = df
    for c in columns:
        codes = ranked.filter(F.col("feature") == c).select(F.col("label").alias(c), F.col("code").cast("double"))
        out = out.join(codes, c, "left").withColumn(c, F.col("code")).drop("code")
    return out.select(*df.columns)


def to_numeric(df: DataFrame, features: Sequence[str], numeric: Sequence[str] | None = None) -> DataFrame:
    """All features as doubles.

    Declared ``numeric`` text is read value by value, unreadable values becoming null. Other text is
    read as numbers if all of it can be, else label-encoded.
    """
    text = [c for c in _text_columns(df, features) if c not in (numeric or ())]
    if text:
        labels = distinct_labels(df, text)
        numbers = numeric_text(labels)
        df = encode_labels(df, [c for c in text if c not in numbers], labels)
    return df.withColumns({f: F.col(f).try_cast("double") for f in features})


@dataclass(frozen=True)
class Bracket:
    """Values between which, both included, a feature's middle ranks should lie."""

    feature: str
    n: int
    low: float
    high: float

    @property
    def ranks(self) -> tuple[int, int]:
        """The one or two middle ranks, counted from 1."""
        return (self.n + 1) // 2, self.n // 2 + 1


def _bracket_frame(long: DataFrame, brackets: Sequence[Bracket]) -> DataFrame:
    rows = {name: [getattr(b, name) for b in brackets] for name in ("feature", "n", "low", "high")}
    kinds = {"feature": pa.string(), "n": pa.int64(), "low": pa.float64(), "high": pa.float64()}
    # One row per feature, so the broadcast is as small as the feature list.
    return long.join(F.broadcast(local_frame(long.sparkSession, rows, kinds)), "feature")


def _first_brackets(long: DataFrame) -> list[Bracket]:
    """Brackets from one sketch per feature, with a margin above its rank error."""
    edges = F.percentile_approx("value", [0.5 - BRACKET, 0.5 + BRACKET], SKETCH_ACCURACY)
    rows = long.groupBy("feature").agg(F.count(F.lit(1)).alias("n"), edges.alias("q")).collect()
    return [Bracket(r.feature, r.n, r.q[0], r.q[1]) for r in rows]


def _checked(long: DataFrame, brackets: Sequence[Bracket]) -> tuple[list[Bracket], list[Bracket]]:
    """Brackets that are ready to be ranked, and better ones for the others.

    Rows below and inside are counted exactly. A bracket that misses a middle rank is opened on that side,
    one that holds too many rows of several values is replaced from a sketch of the rows strictly inside.
    """
    value = F.col("value")
    within = (value > F.col("low")) & (value < F.col("high"))
    grid = [i / GRID for i in range(GRID + 1)]
    counts = _bracket_frame(long, brackets).groupBy("feature").agg(
        F.count_if(value < F.col("low")).alias("below"),
        F.count_if(value <= F.col("high")).alias("upto"),
        F.count_if(value <= F.col("low")).alias("at_low"),
        F.count_if(within).alias("inside"),
        F.percentile_approx(F.when(within, value), grid, SKETCH_ACCURACY).alias("grid"),
    )
    counted = {r.feature: r for r in counts.collect()}
    ready, better = [], []
    for b in brackets:
        r, (lower, upper) = counted[b.feature], b.ranks
        if lower <= r.below or upper > r.upto:
            better.append(Bracket(b.feature, b.n, float("-inf") if lower <= r.below else b.low, float("inf") if upper > r.upto else b.high))
        elif r.inside <= WINDOW_ROWS:
            ready.append(b)
        else:
            # Two grid steps on either side cover the sketch's error many times over.
            first = (lower - r.at_low) * GRID // r.inside - 2
            last = -(-(upper - r.at_low) * GRID // r.inside) + 2
            low = r.grid[min(first, GRID)] if first > 0 else b.low
            high = r.grid[max(last, 0)] if last < GRID else b.high
            better.append(Bracket(b.feature, b.n, low, high))
    return ready, better


def _bracketed_medians(long: DataFrame, brackets: Sequence[Bracket]) -> DataFrame:
    zone = F.when(F.col("value") < F.col("low"), -1).when(F.col("value") > F.col("high"), 1).otherwise(0)
    counted = (
        _bracket_frame(long, brackets)
        .withColumn("zone", zone)
        .withColumn("value", F.when(F.col("zone") == 0, F.col("value")))
        .groupBy("feature", "n", "zone", "value")
        .agg(F.count(F.lit(1)).alias("rows"))
    )
    upto = F.sum("rows").over(Window.partitionBy("feature").orderBy("zone", "value"))
    lower, upper = F.expr("(n + 1) DIV 2"), F.expr("n DIV 2 + 1")

    def at(position: Column) -> Column:
        covers = (F.col("upto") - F.col("rows") < position) & (position <= F.col("upto"))
        return F.max(F.when(covers, F.col("value")))

    return counted.withColumn("upto", upto).groupBy("feature").agg(
        ((at(lower) + at(upper)) / 2).alias("median")
    )


def medians(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Exact ``(feature, median)``, nulls and NaN skipped.

    A quantile sketch brackets the middle rank with a margin above its error bound. Exact counts then
    tell whether a bracket holds its ranks and how many rows; it is opened or narrowed until it holds them and at most
    ``WINDOW_ROWS`` rows lie strictly inside, which always ends, as every sketch leaves a fraction of the rows or a single
    value. Only these values are ranked, so one task never ranks more.
    """
    long = (
        df.select(*[F.col(f).cast("double").alias(f) for f in features])
        .unpivot([], list(features), "feature", "value")
        .filter(F.col("value").isNotNull() & ~F.isnan("value"))
    )
    ready, open_ = [], _first_brackets(long)
    while open_:
        done, open_ = _checked(long, open_)
        ready += done
    return _bracketed_medians(long, ready)


def median_values(df: DataFrame, features: Sequence[str]) -> dict[str, float]:
    """Medians as numbers, one per feature that has any value."""
    return {r.feature: r["median"] for r in medians(df, features).collect()}


def impute(df: DataFrame, features: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """Missing values filled with the median of both arms; features without any value are dropped."""
    values = median_values(df, features)
    kept = [f for f in features if f in values]
    doubles = df.withColumns({f: F.col(f).cast("double") for f in kept})
    return doubles.fillna(values), kept


def scale(df: DataFrame, features: Sequence[str], prefix: str = "z_") -> DataFrame:
    """Standardised copies of the features, by population deviation; a constant column has scale 1."""
    stats = df.agg(
        *[F.avg(f).alias(f"m_{f}") for f in features], *[F.stddev_pop(f).alias(f"s_{f}") for f in features]
    ).first()
    return df.withColumns(
        {prefix + f: (F.col(f) - F.lit(stats[f"m_{f}"])) / F.lit(stats[f"s_{f}"] or 1.0) for f in features}
    )


@dataclass(frozen=True)
class ScoreModel:
    """Intercept and one coefficient per scaled feature."""

    intercept: float
    coefficients: Mapping[str, float]

    def linear(self) -> Column:
        total = F.lit(self.intercept)
        for name, weight in self.coefficients.items():
            total = total + F.lit(weight) * F.col(name)
        return total


def fit_model(df: DataFrame, columns: Sequence[str], label: str = TREATMENT, strength: float = 1.0,
              max_iter: int = 1000) -> ScoreModel:
    """L2-penalised logistic regression with a free intercept.

    ``strength`` weighs the summed loss against half the squared norm, hence the penalty of
    ``1 / (strength * n)`` on the mean loss. The columns are already scaled.
    """
    assembled = VectorAssembler(inputCols=list(columns), outputCol="features").transform(
        df.select(*columns, F.col(label).cast("double").alias("label"))
    ).select("features", "label")
    penalty = 1.0 / (strength * df.count())
    model = LogisticRegression(
        regParam=penalty, elasticNetParam=0.0, standardization=False, maxIter=max_iter, tol=1e-10
    ).fit(assembled)
    return ScoreModel(float(model.intercept), dict(zip(columns, map(float, model.coefficients))))


def add_scores(df: DataFrame, model: ScoreModel) -> DataFrame:
    """``propensity_score`` and ``logit_ps``, the logit of the clipped score."""
    score = 1.0 / (1.0 + F.exp(-model.linear()))
    return add_logit(df.withColumn("propensity_score", score))


def add_logit(df: DataFrame, score: str = "propensity_score") -> DataFrame:
    clipped = F.greatest(F.least(F.col(score), F.lit(CLIP_HIGH)), F.lit(CLIP_LOW))
    return df.withColumn("logit_ps", F.log(clipped / (1 - clipped)))


def score_ranges(scored: DataFrame) -> DataFrame:
    return scored.groupBy(TREATMENT).agg(
        F.count(F.lit(1)).alias("n"),
        F.min("propensity_score").alias("min_score"),
        F.max("propensity_score").alias("max_score"),
    )
