"""Covariate balance between arms."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from .propensity import TREATMENT

# Fixed value: a standardised difference above this counts as imbalance.
IMBALANCE = 0.1


def standardized_differences(df: DataFrame, features: Sequence[str], skip_empty: bool = False) -> DataFrame:
    """``feature, user_mean, non_user_mean, smd`` from one aggregation over both arms.

    The pooled deviation uses sample variances; a zero or undefined one gives 0. With
    ``skip_empty`` features without a value in either arm are left out.
    """
    present = [f for f in features if f in df.columns]
    columns = []
    for f in present:
        for arm in (1, 0):
            value = F.when(F.col(TREATMENT) == arm, F.col(f).cast("double"))
            columns += [F.avg(value).alias(f"mean{arm}_{f}"), F.var_samp(value).alias(f"var{arm}_{f}")]
    row = df.agg(*columns)
    entries = [
        F.struct(
            F.lit(f).alias("feature"),
            F.col(f"mean1_{f}").alias("user_mean"),
            F.col(f"mean0_{f}").alias("non_user_mean"),
            F.sqrt((F.col(f"var1_{f}") + F.col(f"var0_{f}")) / 2).alias("pooled"),
        )
        for f in present
    ]
    gap = F.abs(F.col("user_mean") - F.col("non_user_mean"))
    smd = F.when(F.col("pooled") > 0, gap / F.col("pooled")).otherwise(F.lit(0.0))
    long = row.select(F.inline(F.array(*entries)))
    if skip_empty:
        long = long.filter(F.col("user_mean").isNotNull() & F.col("non_user_mean").isNotNull())
    return long.select("feature", "user_mean", "non_user_mean", smd.alias("smd"))


def before_and_after(before: DataFrame, after: DataFrame, features: Sequence[str]) -> DataFrame:
    """Differences before and after matching with a balance flag, one row per feature."""
    first = standardized_differences(before, features, skip_empty=True).select("feature", F.col("smd").alias("smd_before"))
    second = standardized_differences(after, features, skip_empty=True).select("feature", F.col("smd").alias("smd_after"))
    return first.join(second, "feature", "left").withColumn("balanced", F.col("smd_after") <= IMBALANCE)


def imbalanced(smd: DataFrame, top: int = 5) -> DataFrame:
    """The ``top`` worst features above the threshold."""
    return smd.filter(F.col("smd") > IMBALANCE).orderBy(F.desc("smd"), "feature").limit(top)
