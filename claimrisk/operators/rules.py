"""Rules that hold from a date until the next rule for the same key."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from claimrisk.operators.joins import fits_broadcast, hot_keys

SPAN_DAYS = 64   # rows and rules of a key are sorted together within so many days


def validity(rules: DataFrame, key: str) -> DataFrame:
    """Each rule with the date its successor takes over; null for the rule in force."""
    later = Window.partitionBy(key).orderBy("valid_from")
    return rules.withColumn("valid_to", F.lead("valid_from").over(later))


def _span(day: str):
    return F.floor(F.unix_date(F.col(day)) / SPAN_DAYS)


def effective(rows: DataFrame, rules: DataFrame, key: str, day: str, value: str, row_id: str
              ) -> DataFrame:
    """Each row with the rule value in force on its day; null before the first rule.

    An as-of join.  Rows and rules are cut by key and span of days, put into one table and sorted
    there by day, rules first; each row takes the last rule before it.  What a span inherits comes
    from a table of the last rule of every (key, span), carried forward.  No row holds the
    revisions of a key, and a key of many rows or rules is many spans; spans of very many rows are
    cut further by row.  Of rules of one key and day the greatest value holds.  A row without key
    or day has no rule.
    """
    rows = rows.withColumn("_span", _span(day))
    dated = rules.where(F.col(key).isNotNull() & F.col("valid_from").isNotNull()).select(
        key, F.col("valid_from").alias("_day"), F.col(value).alias("_value"), _span("valid_from").alias("_span"))
    # the last rule of every span, carried to the spans after it: at most a row per key and span
    last = dated.groupBy(key, "_span").agg(F.max(F.struct("_day", "_value")).alias("_last"))
    spans = rows.where(F.col(key).isNotNull()).select(key, "_span").distinct().unionByName(
        last.select(key, "_span")).distinct()
    before = Window.partitionBy(key).orderBy("_span").rowsBetween(Window.unboundedPreceding, -1)
    inherited = spans.join(last, [key, "_span"], "left").withColumn(
        "_before", F.last("_last", ignorenulls=True).over(before)).select(key, "_span", F.col("_before._value").alias("_inherited"))

    sizes = rows.groupBy(key, "_span").agg(F.count("*").alias("_n"))
    hot = hot_keys(sizes, [key, "_span"], "_n")
    splits, cut = F.coalesce("_splits", F.lit(1)), not hot.isEmpty()

    def placed(df, slot):
        return (df.join(F.broadcast(hot), [key, "_span"], "left").withColumn("_slot", slot).drop("_splits")
                if cut else df.withColumn("_slot", F.lit(0)))

    nothing = F.lit(None)
    own = rows.columns
    events = placed(dated, F.explode(F.sequence(F.lit(0), splits - 1)))
    asked = placed(rows, F.pmod(F.xxhash64(row_id), splits).cast("int"))
    # a null key joins nothing; its rows are dealt by id
    asked = asked.withColumn("_slot", F.when(F.col(key).isNull() | F.col(day).isNull(), F.pmod(F.xxhash64(row_id), F.lit(1 << 30)).cast("int"))
                             .otherwise(F.col("_slot")))
    both = asked.withColumns({"_day": F.col(day).cast("date"), "_rule": nothing.cast(
        f"struct<v:{rules.schema[value].dataType.simpleString()}>"), "_asks": F.lit(1)}).unionByName(
        events.select(key, "_span", "_slot", "_day", F.struct(F.col("_value").alias("v")).alias("_rule"),
                      F.lit(0).alias("_asks")), allowMissingColumns=True)
    order = Window.partitionBy(key, "_span", "_slot").orderBy("_day", "_asks", "_rule").rowsBetween(
        Window.unboundedPreceding, 0)
    found = both.withColumn("_own", F.last("_rule", ignorenulls=True).over(order)).where("_asks = 1").select(*own, "_own")
    if fits_broadcast(inherited):
        inherited = F.broadcast(inherited)
    return found.join(inherited, [key, "_span"], "left").withColumn(
        value, F.when(F.col("_own").isNotNull(), F.col("_own.v")).otherwise(F.col("_inherited"))).drop(
        "_own", "_inherited", "_span")
