"""Model and rule evaluation as distributed aggregates."""

from __future__ import annotations

from functools import reduce
from math import ceil
from operator import add

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from claimrisk.functions.columns import cents, flag
from claimrisk.operators.ranking import first_per_group
from claimrisk.schemas import (
    DAILY_REVIEWS,
    REVIEW_COST,
    SPLIT_QUANTILE,
    THRESHOLD_STEP,
    THRESHOLD_STOP,
)
from claimrisk.session import written

SCORE_BUCKETS = 256


# --- rules and labels --------------------------------------------------------------------
def label_summary(claims: DataFrame) -> DataFrame:
    """Claims, mean and total amount per label."""
    total = F.sum(cents(F.col("amount"))).cast("double")
    return claims.groupBy("label").agg(
        F.count("*").alias("claims"),
        F.round(total / F.count("*"), 2).alias("mean_amount"),
        total.alias("total_amount"),
    )


def rule_confusion(claims: DataFrame, rule: Column) -> DataFrame:
    """Counts per (flagged, label)."""
    return claims.groupBy(flag(rule).alias("flagged"), "label").agg(F.count("*").alias("n"))


def rule_quality(claims: DataFrame, rule: Column) -> DataFrame:
    """One row: hits, false alarms, misses, precision and recall of a rule."""
    hit = F.coalesce(rule, F.lit(False))
    positive = F.col("label") == 1
    counts = claims.agg(
        F.count_if(hit & positive).alias("tp"),
        F.count_if(hit & ~positive).alias("fp"),
        F.count_if(~hit & positive).alias("fn"),
    )
    return counts.withColumns({
        "precision": F.col("tp") / F.greatest(F.col("tp") + F.col("fp"), F.lit(1)),
        "recall": F.col("tp") / F.greatest(F.col("tp") + F.col("fn"), F.lit(1)),
    })


# --- ranking quality ---------------------------------------------------------------------
def score_totals(spark: SparkSession, scored: DataFrame, buckets: int = SCORE_BUCKETS) -> DataFrame:
    """One row per distinct score: its rows and positives, and those scored strictly higher.

    Rows with the same score form one group.  The groups are written once and cut into score
    ranges; each range is summed by itself and the totals of the higher
    ranges (at most ``buckets`` numbers) are added, so no task sees all scores.
    """
    groups = written(
        spark,
        scored.groupBy("score").agg(
            F.count("*").alias("n"), F.sum(F.col("label").cast("long")).alias("tp")),
        "score_groups")
    steps = [i / buckets for i in range(1, buckets)]
    cuts = sorted(set(groups.approxQuantile("score", steps, 0.25 / buckets)))
    ranged = Bucketizer(
        splits=[float("-inf"), *(cuts or [0.0]), float("inf")], inputCol="score", outputCol="_range",
    ).transform(groups)
    higher = Window.orderBy(F.col("_range").desc()).rowsBetween(Window.unboundedPreceding, -1)
    offsets = ranged.groupBy("_range").agg(F.sum("n").alias("_n"), F.sum("tp").alias("_tp")).select(
        "_range",
        F.coalesce(F.sum("_n").over(higher), F.lit(0)).alias("_n_above"),
        F.coalesce(F.sum("_tp").over(higher), F.lit(0)).alias("_tp_above"),
    )
    inside = (
        Window.partitionBy("_range").orderBy(F.col("score").desc())
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    return ranged.select(
        "_range", "score", "n", "tp",
        F.coalesce(F.sum("n").over(inside), F.lit(0)).alias("n_above"),
        F.coalesce(F.sum("tp").over(inside), F.lit(0)).alias("tp_above"),
    ).join(F.broadcast(offsets), "_range").select(
        "score", "n", "tp",
        (F.col("n_above") + F.col("_n_above")).alias("n_above"),
        (F.col("tp_above") + F.col("_tp_above")).alias("tp_above"),
    )


def ranking_quality(spark: SparkSession, scored: DataFrame, **options) -> DataFrame:
    """One row: rows, positives, prevalence, average precision and ROC AUC, exact with ties."""
    c = F.col
    totals = score_totals(spark, scored, **options)
    tp = c("tp").cast("double")  # products of two counts leave 64 bits
    step = tp * ((c("tp_above") + c("tp")) / (c("n_above") + c("n")))
    negatives = c("n") - c("tp")
    above = c("n_above") - c("tp_above")
    sums = totals.agg(
        F.sum("n").alias("rows"),
        F.sum("tp").alias("positives"),
        F.sum(step).alias("_precision"),
        # positives scored below a negative, ties counted half, in doubled units
        F.sum(tp * (2 * above + negatives)).alias("_inversions"),
    )
    neg = c("rows") - c("positives")
    return sums.select(
        "rows", "positives",
        F.try_divide(c("positives"), c("rows")).alias("prevalence"),
        F.round(F.try_divide(c("_precision"), c("positives")), 10).alias("average_precision"),
        F.round(
            1 - F.try_divide(c("_inversions").cast("double"), c("positives").cast("double") * 2 * neg), 10,
        ).alias("roc_auc"),
    )


# --- threshold choice --------------------------------------------------------------------
def threshold_cuts() -> list[float]:
    """The 19 cuts as start + i * step, with their float error."""
    n = ceil((THRESHOLD_STOP - THRESHOLD_STEP) / THRESHOLD_STEP)
    return [THRESHOLD_STEP + i * THRESHOLD_STEP for i in range(n)]


def threshold_sweep(scored: DataFrame, cost: float = REVIEW_COST) -> DataFrame:
    """Flagged, precision, recall, value saved and lost, cost and net benefit per cut.

    Each row is counted once, under the number of cuts it reaches; the 20 resulting counters
    are then accumulated from the top.
    """
    spark = scored.sparkSession
    cuts = threshold_cuts()
    reached = reduce(add, [F.when(F.col("score") >= cut, 1).otherwise(0) for cut in cuts])
    positive = F.col("label") == 1
    money = cents(F.col("amount"))
    counted = scored.groupBy(reached.alias("cut")).agg(
        F.count("*").alias("n"),
        F.count_if(positive).alias("tp"),
        F.sum(F.when(positive, money)).cast("decimal(38,2)").alias("value"),
    )
    empty = spark.range(len(cuts) + 1).select(
        F.col("id").cast("int").alias("cut"), F.lit(0).cast("long").alias("n"),
        F.lit(0).cast("long").alias("tp"), F.lit(0).cast("decimal(38,2)").alias("value"))
    counters = counted.unionByName(empty).groupBy("cut").agg(
        F.sum("n").alias("n"), F.sum("tp").alias("tp"),
        F.sum("value").cast("decimal(38,2)").alias("value"))
    up = Window.orderBy(F.col("cut").desc()).rowsBetween(Window.unboundedPreceding, 0)
    everything = Window.orderBy(F.col("cut").desc()).rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing)
    saved, total = F.sum("value").over(up), F.sum("value").over(everything)
    sums = counters.select(
        "cut",
        F.sum("n").over(up).alias("flagged"),
        F.sum("tp").over(up).alias("hits"),
        F.sum("tp").over(everything).alias("positives"),
        saved.cast("double").alias("value_saved"),
        (total - saved).cast("double").alias("value_lost"),
    ).filter("cut > 0")
    c = F.col
    return sums.select(
        F.round(F.col("cut") * F.lit(THRESHOLD_STEP), 2).alias("threshold"),
        "flagged",
        F.coalesce(F.try_divide(c("hits"), c("flagged")), F.lit(0.0)).alias("precision"),
        F.coalesce(F.try_divide(c("hits"), c("positives")), F.lit(0.0)).alias("recall"),
        "value_saved", "value_lost",
        (c("flagged") * cost).alias("review_cost"),
        F.round(c("value_saved") - c("flagged") * cost, 2).alias("net_benefit"),
    )


def best_threshold(sweep: DataFrame) -> DataFrame:
    """The cut with the highest net benefit, the lowest on ties."""
    return sweep.orderBy(F.col("net_benefit").desc(), "threshold").limit(1)


def capacity_cut(scored: DataFrame, per_day: int = DAILY_REVIEWS, day: str = "req_date") -> DataFrame:
    """Reviews kept per day under a daily capacity and the score threshold that implies."""
    kept = first_per_group(scored, [day], [F.col("score").desc(), "claim_id"], per_day)
    return kept.groupBy(day).agg(
        F.count("*").alias("kept"), F.min("score").alias("implied_threshold"))


# --- split -------------------------------------------------------------------------------
def split_day(rows: DataFrame, day: str = "req_date", q: float = SPLIT_QUANTILE) -> float:
    """The interpolated quantile of the day number; its state is one counter per calendar day."""
    return rows.agg(F.percentile(F.unix_date(day), F.lit(q)).alias("cut")).first()["cut"]


def time_split(rows: DataFrame, day: str = "req_date", q: float = SPLIT_QUANTILE
               ) -> tuple[DataFrame, DataFrame]:
    """Rows up to and including the cut, and rows after it."""
    cut = split_day(rows, day, q)
    if cut is None:
        return rows, rows.limit(0)
    number = F.unix_date(day)
    return rows.filter(number <= F.lit(cut)), rows.filter(number > F.lit(cut))


# --- leakage -----------------------------------------------------------------------------
def leakage_audit(rows: DataFrame, candidates: dict[str, Column]) -> DataFrame:
    """Correlation with the label and null rate of each candidate, in one pass."""
    aggs = []
    for name, column in candidates.items():
        aggs += [
            F.corr(column.cast("double"), F.col("label").cast("double")).alias(f"{name}__corr"),
            F.avg(F.when(column.isNull(), 1.0).otherwise(0.0)).alias(f"{name}__null"),
        ]
    wide = rows.agg(*aggs)
    stack = ", ".join(f"'{n}', `{n}__corr`, `{n}__null`" for n in candidates)
    return wide.selectExpr(f"stack({len(candidates)}, {stack}) AS (candidate, correlation, null_rate)")


def assert_no_leak(features: list[str], forbidden: list[str]) -> None:
    leaked = sorted(set(features) & set(forbidden))
    if leaked:
        raise ValueError(f"known only after the decision: {leaked}")
