"""Signals that only show across rows and tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimrisk.functions.columns import whole_cents

NO_SITE = "NA"
PRICE_RANGE = 10_000  # cents


def site_key(site: str = "site") -> Column:
    """The site with null turned into a value, so that null matches null."""
    return F.coalesce(F.col(site), F.lit(NO_SITE))


def reference_prices(network: DataFrame) -> DataFrame:
    """Exact (lower) median network price per procedure code.

    Prices are counted by whole cents and, coarser, by ranges of ``PRICE_RANGE`` cents.  The range in
    which a code's count passes one half is found first, then the price within it, so no task
    holds more of a code than its ranges or the prices of one of them.
    """
    priced = network.where("amount is not null").groupBy(
        "proc_code", whole_cents(F.col("amount")).alias("price")).agg(F.count("*").alias("n"))
    priced = priced.withColumn("range", F.floor(F.col("price") / PRICE_RANGE))
    of_code = Window.partitionBy("proc_code")
    before = of_code.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = priced.groupBy("proc_code", "range").agg(F.sum("n").alias("rows")).withColumns({
        "before": F.coalesce(F.sum("rows").over(before), F.lit(0)),
        "half": (F.sum("rows").over(of_code) + 1).cast("decimal(38,0)") / 2,
    }).withColumn("half", F.floor("half")).where(
        (F.col("before") < F.col("half")) & (F.col("before") + F.col("rows") >= F.col("half")))
    upto = of_code.orderBy("price").rowsBetween(Window.unboundedPreceding, 0)
    return (
        priced.join(ranges.drop("rows"), ["proc_code", "range"])
        .where("half is not null").withColumn("upto", F.col("before") + F.sum("n").over(upto))
        .where(F.col("upto") >= F.col("half")).groupBy("proc_code")
        .agg((F.min("price") / 100.0).alias("reference_price")))


def document_counts(rows: DataFrame, document: str = "document", row_id: str = "claim_id") -> DataFrame:
    """Documents with the number of rows that present them."""
    return rows.where(F.col(document).isNotNull()).groupBy(document).agg(
        F.count(row_id).alias("document_rows"))


def repeated_documents(rows: DataFrame, document: str = "document", row_id: str = "claim_id") -> DataFrame:
    """Documents presented more than once, with the number of rows."""
    return document_counts(rows, document, row_id).filter("document_rows > 1")


def network_marks(network: DataFrame) -> DataFrame:
    """Distinct (member, code, site) the network already paid for; one row each, so no fan-out."""
    return (
        network.select("member_id", "proc_code", site_key().alias("site_key")).distinct()
        .withColumn("in_network_too", F.lit(1))
    )


def first_events(network: DataFrame, code: str) -> DataFrame:
    """Earliest date of one procedure code per (member, site)."""
    return (
        network.filter((F.col("proc_code") == code) & F.col("site").isNotNull())
        .groupBy("member_id", "site").agg(F.min("proc_date").alias("removed_on"))
    )
