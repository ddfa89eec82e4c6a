"""Quality rules: text statistics, a base rule and robust multivariate outliers.

Documents that pass the base rule become vectors of transformed statistics.  A minimum covariance
determinant estimate is fitted for each language and source, for each language and for all: from
two starts (medians with absolute deviations, and mean with covariance) the share ``SUPPORT`` of
documents that is nearest is kept and mean and covariance are taken anew, until no determinant
falls any more; the start with the least determinant is taken, scaled to its median distance and
reweighted once.  The estimate of a source is then drawn towards that of its language, and that
towards all, with weight n / (n + ``PRIOR``), so that groups of any size are judged by one rule.
Documents whose squared Mahalanobis distance is above a chi-square quantile are rejected.

All steps are counts and sums per group over histograms, so no group is gathered in one task and
what a task holds does not depend on a group's size.  Estimates are sent to the rows where they are
few, after a count.  Standard deviations are at least ``FLOORS``, in every direction, because most documents share the
same value of some statistics.

Null texts have no words and fail the base rule.  Null languages and sources form groups of their
own.  Equal texts of a group get equal verdicts; empty tables give empty results.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from claimrisk.session import intermediate, written

SYMBOLS = "#*$%&|<>"
WINDOW = 5
LEAST_WORDS, MOST_REPEATED = 10, 20  # words; per cent of words in repeated windows
SUPPORT, MOST_STEPS, PRIOR = 0.75, 30, 50
REWEIGHT, REJECT = 0.975, 1 - 1e-9  # chi-square probabilities
FLOORS = (0.6, 0.6, 0.08, 0.5, 0.1)  # least standard deviation of each feature
P = len(FLOORS)
STATISTICS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"
GROUP = ["group_lang", "group_source"]
SENT = 50_000  # estimates of some hundred bytes that are sent to every task


def repeated_words(words: list[bytes]) -> int:
    """Words that lie in a window which occurs twice or more."""
    n = len(words) - WINDOW + 1
    if n < 2:
        return 0
    ids: dict[bytes, int] = {}
    numbers = np.fromiter((ids.setdefault(w, len(ids)) for w in words), np.int64, len(words))
    size = len(words)
    key = numbers[:n]
    for k in range(1, WINDOW):  # equal prefixes get equal numbers below the word count
        _, key = np.unique(key * size + numbers[k:k + n], return_inverse=True)
    again = np.bincount(key)[key] > 1
    if not again.any():
        return 0
    inside = np.zeros(size, bool)
    for k in range(WINDOW):
        inside[k:k + n] |= again
    return int(inside.sum())


def statistics_of(text: str | None) -> tuple[int, int, int, int, int]:
    if not text:
        return 0, 0, 0, 0, 0
    data = text.encode()
    words = data.split()  # at blank, \t, \n, \v, \f and \r
    lines = [line for line in data.split(b"\n") if line.strip()] if b"\n" in data else []
    chars = len(text) - sum(map(text.count, " \t\n\v\f\r"))
    return (len(words), chars, sum(map(text.count, SYMBOLS)), len(lines) - len(set(lines)),
            repeated_words(words))


def with_statistics(docs: DataFrame) -> DataFrame:
    """The documents with a struct column ``stats`` over the whole text."""
    names = [c.split()[0] for c in STATISTICS.split(", ")]

    @F.pandas_udf(STATISTICS)
    def stats(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([statistics_of(t) for t in texts], columns=names, dtype="int64")

    return docs.withColumn("stats", stats("text"))


def base_failed() -> Column:
    n = F.col("stats.n_words")
    return (n < LEAST_WORDS) | (100 * F.col("stats.n_repeat_words") > MOST_REPEATED * n)


def features() -> list[Column]:
    """Transformed statistics: length, word length, symbols, repeated lines, repeated words."""
    s = {n: F.col(f"stats.{n}").cast("double") for n in
         ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")}
    n = F.greatest(s["n_words"], F.lit(1.0))
    return [F.log(n), s["word_chars"] / n, F.sqrt(s["n_symbols"] / n), F.log1p(s["n_dup_lines"]),
            F.sqrt(s["n_repeat_words"] / n)]


def chi_square_quantile(probability: float, degrees: int) -> float:
    """By bisection of the regularised incomplete gamma function (complement by its series)."""
    def above(x: float) -> float:
        a, z = degrees / 2, x / 2
        if z < a + 1:
            term = total = 1 / a
            k = a
            while term > total * 1e-17:
                k += 1
                term *= z / k
                total += term
            return 1 - total * math.exp(a * math.log(z) - z - math.lgamma(a))
        tail = 0.0
        for k in range(400, 0, -1):  # continued fraction from its far end
            tail = k * (k - a) / (z + 2 * k + 1 - a - tail)
        return math.exp(a * math.log(z) - z - math.lgamma(a)) / (z + 1 - a - tail)

    low, high = 1e-9, 1e4
    for _ in range(200):
        middle = (low + high) / 2
        low, high = (middle, high) if above(middle) > 1 - probability else (low, middle)
    return low


def _quantile(bins: DataFrame, keys: list[str], share: float) -> DataFrame:
    """keys and the least bin at which ``share`` of the rows is reached; bins: keys, bin, count."""
    w = Window.partitionBy(*keys)
    return (
        bins.withColumn("upto", F.sum("count").over(
            w.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn("rows", F.sum("count").over(w))
        .where(F.col("upto") >= F.floor(share * F.col("rows")))
        .groupBy(*keys).agg(F.min("bin").alias("bin")))


def _distance() -> Column:
    """Squared distance from the columns x (array), mean and root (inverse Cholesky factor)."""
    out = F.lit(0.0)
    for i in range(P):
        row = F.lit(0.0)
        for j in range(i + 1):
            row += F.col("root")[i * P + j] * (F.col("x")[j] - F.col("mean")[j])
        out += row * row
    return out


def _distance_bin(d: Column) -> Column:
    """64 bins for each doubling."""
    return F.floor(64 * F.log2(F.greatest(d, F.lit(1e-9)))).cast("int")


FITTED = [*GROUP, "start"]


def floored(cov: np.ndarray) -> np.ndarray:
    """A covariance matrix whose standard deviation is at least FLOORS, in every direction."""
    unit = np.outer(FLOORS, FLOORS)
    values, directions = np.linalg.eigh((cov + cov.T) / 2 / unit)
    return unit * ((directions * np.maximum(values, 1.0)) @ directions.T)


def _rooted(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Groups with the inverse Cholesky factor and log determinant of their floored covariance."""
    types = dict(rows.dtypes)
    columns = [*keys, "n", "mean", "cov"]
    schema = ", ".join(f"{c} {types[c]}" for c in columns) + ", root array<double>, spread double"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            roots, spread = [], []
            for cov in batch.column(len(columns) - 1).to_pylist():
                factor = np.linalg.cholesky(floored(np.array(cov).reshape(P, P)))
                roots.append(np.linalg.inv(factor).ravel().tolist())
                spread.append(2 * float(np.log(np.diag(factor)).sum()))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(roots, pa.list_(pa.float64())), pa.array(spread, pa.float64())],
                names=[*columns, "root", "spread"])

    return rows.select(columns).mapInArrow(run, schema)


def _estimates(spark: SparkSession, nearest: DataFrame, keys: list[str]) -> DataFrame:
    """Count, mean and covariance of each group, with root and spread, written."""
    x = F.col("x")
    sums = nearest.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"),
        F.array(*[F.avg(x[i]) for i in range(P)]).alias("mean"),
        F.array(*[F.covar_pop(x[i], x[j]) for i in range(P) for j in range(P)]).alias("cov"))
    return written(spark, _rooted(sums, keys), "estimates")


def _met(rows: DataFrame, estimates: DataFrame, keys: list[str]) -> DataFrame:
    """Rows with the estimate of their group; few estimates are sent to the rows."""
    return rows.join(F.broadcast(estimates) if estimates.count() <= SENT else estimates, keys)


def _starts(spark: SparkSession, vectors: DataFrame) -> DataFrame:
    """Two starts of every group: medians and absolute deviations from them; mean and covariance."""
    keys = [*GROUP, "feature"]
    each = vectors.select(*GROUP, F.posexplode("x").alias("feature", "value"))
    grid = 1024

    def medians(values: DataFrame) -> DataFrame:
        return _quantile(values.groupBy(*keys, F.round(F.col("value") * grid).cast("long").alias("bin"))
                         .count(), keys, 0.5).select(*keys, (F.col("bin") / grid).alias("middle"))

    middle = written(spark, medians(each), "medians")
    deviations = medians(_met(each, middle, keys).withColumn("value", F.abs(F.col("value") - F.col("middle"))))
    both = middle.join(deviations.withColumnRenamed("middle", "deviation"), keys).groupBy(*GROUP).agg(
        F.array_sort(F.collect_list(F.struct("feature", "middle", "deviation"))).alias("f"))
    robust = _rooted(both.select(
        *GROUP, F.lit(0).alias("start"), F.lit(0).cast("long").alias("n"), F.col("f.middle").alias("mean"),
        F.array(*[F.pow(F.col("f")[i]["deviation"] * 1.4826, 2) if i == j else F.lit(0.0)
                  for i in range(P) for j in range(P)]).alias("cov")), FITTED)
    plain = _estimates(spark, vectors, GROUP).withColumn("start", F.lit(1))
    return written(spark, robust.unionByName(plain), "starts")


def _shares(rows: DataFrame, estimate: DataFrame, keys: list[str], share: float) -> DataFrame:
    """The bin of distances at which a share of each group is reached."""
    binned = _met(rows, estimate, keys).withColumn("near", _distance_bin(_distance()))
    return _quantile(binned.groupBy(*keys, F.col("near").alias("bin")).count(), keys, share)


def concentrated(spark: SparkSession, vectors: DataFrame) -> tuple[DataFrame, int]:
    """The estimate of least determinant of every group, and the steps it took."""
    rows = vectors.withColumn("start", F.explode(F.array(F.lit(0), F.lit(1))))

    def step(estimate: DataFrame) -> DataFrame:
        limit = _shares(rows, estimate, FITTED, SUPPORT)
        near = _met(rows, estimate.join(limit, FITTED), FITTED)
        return _estimates(spark, near.where(_distance_bin(_distance()) <= F.col("bin")), FITTED)

    best, steps = step(_starts(spark, vectors)), 1
    while steps < MOST_STEPS:
        new = step(best).select(*FITTED, *[F.col(c).alias(f"new_{c}") for c in ("n", "mean", "cov", "root", "spread")])
        both = written(spark, best.join(new, FITTED).withColumn(
            "falls", F.col("new_spread") < F.col("spread") - 1e-6), "step")
        steps += 1
        if both.where("falls").isEmpty():
            break
        best = both.select(*FITTED, *[F.when(F.col("falls"), F.col(f"new_{c}")).otherwise(F.col(c)).alias(c)
                                      for c in ("n", "mean", "cov", "root", "spread")])
    least = Window.partitionBy(*GROUP).orderBy("spread", "start")
    return written(spark, best.withColumn("nth", F.row_number().over(least)).where("nth = 1").drop(
        "nth", "start"), "concentrated"), steps


def fit(spark: SparkSession, vectors: DataFrame) -> DataFrame:
    """One row per group: n (of all its rows), mean, cov, root and scale; vectors: group columns and x."""
    def scaled(estimate: DataFrame) -> DataFrame:
        """Median distance over its expectation, not below 1."""
        return estimate.join(_shares(vectors, estimate, GROUP, 0.5), GROUP).withColumn("scale", F.greatest(
            F.pow(F.lit(2.0), (F.col("bin") + 1) / 64) / chi_square_quantile(0.5, P), F.lit(1.0))).drop("bin")

    raw = written(spark, scaled(concentrated(spark, vectors)[0]), "raw")
    estimate = _estimates(spark, _met(vectors, raw, GROUP).where(
        _distance() <= chi_square_quantile(REWEIGHT, P) * F.col("scale")), GROUP)
    sizes = vectors.groupBy(*GROUP).agg(F.count(F.lit(1)).alias("n"))
    return written(spark, scaled(estimate.drop("n").join(sizes, GROUP)), "robust")


def shrunk(spark: SparkSession, robust: DataFrame) -> DataFrame:
    """mean, root and scale of every language and source, drawn towards language and all.

    ``robust`` holds a row per language and source (source = name), language (source empty) and for
    all (both empty).
    """
    level = {"source": F.col("group_source").startswith("="),
             "lang": F.col("group_lang").startswith("=") & (F.col("group_source") == ""),
             "all": (F.col("group_lang") == "") & (F.col("group_source") == "")}

    def drawn(own: DataFrame, wider: DataFrame, keys: list[str]) -> DataFrame:
        weight = F.col("n") / (F.col("n") + PRIOR)

        def mixed(name):
            return F.zip_with(name, f"wide_{name}", lambda a, b: weight * a + (1 - weight) * b).alias(name)
        wide = wider.select(*keys, *[F.col(c).alias(f"wide_{c}") for c in ("mean", "cov", "scale")])
        joined = own.join(wide, keys) if keys else own.crossJoin(F.broadcast(wide))  # one row
        return joined.select(*GROUP, "n", mixed("mean"), mixed("cov"),
                             (weight * F.col("scale") + (1 - weight) * F.col("wide_scale")).alias("scale"))

    langs = drawn(robust.where(level["lang"]), robust.where(level["all"]), [])
    sources = written(spark, drawn(robust.where(level["source"]), langs, ["group_lang"]), "drawn")
    return written(spark, _rooted(sources, GROUP).join(sources.select(*GROUP, "scale"), GROUP), "shrunk")


def judged(spark: SparkSession, docs: DataFrame, keep: list[str]) -> DataFrame:
    """row (struct of the columns to keep), stats, base_failed, distance (null if not judged), kept.

    The documents are written once with their statistics; everything else reads that table.
    """
    table = written(spark, with_statistics(docs.select(
        F.struct(*[docs[c] for c in keep]).alias("row"),
        *[F.concat(F.lit("="), F.coalesce(F.col(c).cast("string"), F.lit(""))).alias(f"group_{c}")
          for c in ("lang", "source")], "text")).drop("text"), "statistics")
    vectors = table.where(~base_failed()).select(*GROUP, F.array(*features()).alias("x"))
    levels = F.array(*[F.struct(lang.alias("group_lang"), source.alias("group_source")) for lang, source in (
        (F.col("group_lang"), F.col("group_source")), (F.col("group_lang"), F.lit("")), (F.lit(""), F.lit("")))])
    with intermediate(spark) as tables:
        rows = written(spark, vectors.select("x", F.explode(levels).alias("level")).select("level.*", "x"), "vectors")
        chosen = tables.keep(written(spark, shrunk(spark, fit(spark, rows)).select(
            *GROUP, "mean", "root", "scale"), "chosen"))
    chosen = F.broadcast(chosen) if chosen.count() <= SENT else chosen
    distance = F.when(~base_failed(), _distance() / F.col("scale"))
    near = F.coalesce(F.col("distance") <= chi_square_quantile(REJECT, P), F.lit(True))
    return (
        table.join(chosen, GROUP, "left").withColumn("x", F.array(*features()))
        .withColumn("distance", distance)
        .select("row", "stats", base_failed().alias("base_failed"), "distance",
                (~base_failed() & near).alias("kept")))


def verdicts(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """doc_id, the statistics, base_failed, kept and distance of every document."""
    return judged(spark, docs, ["doc_id"]).select(
        "row.doc_id", "stats.*", "base_failed", "kept", "distance")


def accepted(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """The documents that are kept, with their columns."""
    return judged(spark, docs, docs.columns).where("kept").select("row.*")
