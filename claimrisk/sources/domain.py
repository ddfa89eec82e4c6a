"""The claims domain: catalog tables under the names used here, and the view that maps the
parquet order tables onto claims, network procedures, members, providers and plans."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from claimrisk.functions.columns import approved_amount
from claimrisk.schemas import AUDIT_CEILING, EXTRACTION_CODE
from claimrisk.sources.tables import catalog_table, read_table

# Constants of the mapped data: another price level, another event code.
MAPPED_CEILING = 60000.0
MAPPED_EVENT = "ECONOMY"
ROWS_PER_LINE = 1_000_000


@dataclass(frozen=True)
class Domain:
    claims: DataFrame
    network: DataFrame
    members: DataFrame
    providers: DataFrame
    plans: DataFrame
    ceiling: float = AUDIT_CEILING
    event_code: str = EXTRACTION_CODE


def catalog_domain(spark: SparkSession, schema: str) -> Domain:
    """The five source tables of a catalog schema."""
    def table(name):
        return catalog_table(spark, f"{schema}.{name}")
    return Domain(
        claims=table("silver_pedidos_reembolso"),
        network=table("silver_procedimentos_rede"),
        members=table("silver_beneficiarios"),
        providers=table("silver_prestadores"),
        plans=table("silver_planos"),
    )


def treatments(spark: SparkSession, root: str) -> DataFrame:
    """One row per row of lineitem: claims and network procedures together.

    An order line may occur several times; its rows are numbered in a total order of their other
    columns, so that ids are unique and repeatable.  A line of more than ``ROWS_PER_LINE`` rows
    would repeat ids; reading it raises.
    """
    own = ["l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", "l_shipdate",
           "l_returnflag", "l_linestatus"]
    of_line = Window.partitionBy("l_orderkey", "l_linenumber").orderBy(*own)
    # lines are moved by their order once, for the numbers and for the join with the orders; what
    # the part does not need is reduced before they move by part
    line = read_table(spark, root, "lineitem").select("l_orderkey", "l_linenumber", *own).where(
        "l_orderkey IS NOT NULL").repartition("l_orderkey").withColumn("nth", F.row_number().over(of_line) - 1)
    orders = read_table(spark, root, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    part = read_table(spark, root, "part").select("p_partkey", "p_type", "p_brand", "p_size")
    dated = line.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        "l_orderkey", "l_linenumber", "nth", "l_partkey", "l_suppkey", "l_extendedprice",
        F.least("o_orderdate", "l_shipdate").cast("date").alias("proc_date"),
        F.greatest("o_orderdate", "l_shipdate").cast("date").alias("req_date"),
        "o_custkey", "l_returnflag", "l_linestatus")
    joined = dated.join(part, F.col("l_partkey") == F.col("p_partkey"))
    return joined.select(
        F.when(F.col("nth") < ROWS_PER_LINE,
               (F.col("l_orderkey") * 10 + F.col("l_linenumber")) * ROWS_PER_LINE + F.col("nth"))
        .otherwise(F.raise_error(F.lit(f"an order line has more than {ROWS_PER_LINE} rows"))).alias("claim_id"),
        F.col("o_custkey").alias("member_id"),
        F.col("l_suppkey").alias("provider_id"),
        F.col("p_type").alias("proc_code"),
        F.when(F.col("p_size") % 4 != 0, F.col("p_brand")).alias("site"),
        "proc_date", "req_date",
        F.col("l_extendedprice").alias("amount"),
        F.concat(F.lit("NF"), "l_suppkey", F.lit("-"), "l_partkey").alias("document"),
        F.col("l_returnflag"),
        F.col("l_linestatus"),
    )


def claims(rows: DataFrame) -> DataFrame:
    return (
        rows.filter("l_returnflag <> 'N'")
        .withColumn("label", F.when(F.col("l_returnflag") == "R", 1).otherwise(0))
        .withColumnRenamed("l_linestatus", "decision").drop("l_returnflag")
    )


def decided(claims: DataFrame, rates: DataFrame) -> DataFrame:
    """Claims with the columns that are known only after the decision.

    Every third claim that was not denied is still open: it has no amount and no review date.
    ``rates``: member_id and plan_rate.
    """
    denied, pending = F.col("decision") == "F", (F.col("decision") != "F") & (F.col("claim_id") % 3 == 0)
    return claims.join(rates, "member_id", "left").withColumns({
        "status": F.when(denied, "denied").when(pending, "open").otherwise("paid"),
        "approved_amount": F.when(~pending, approved_amount(F.col("amount"), F.col("plan_rate"), denied)),
        "denial_reason": F.when(denied, F.when(F.col("claim_id") % 2 == 0, "duplicate").otherwise("coverage")),
        "review_date": F.when(~pending, F.date_add("req_date", (F.col("claim_id") % 10 + 1).cast("int"))),
    })


def network(rows: DataFrame) -> DataFrame:
    return rows.filter("l_returnflag = 'N'").select(
        F.col("claim_id").alias("procedure_id"), "member_id", "provider_id", "proc_code", "site",
        "proc_date", "amount")


def members(spark: SparkSession, root: str) -> DataFrame:
    return read_table(spark, root, "customer").select(
        F.col("c_custkey").alias("member_id"),
        F.col("c_name").alias("member_name"),
        F.col("c_nationkey").alias("region"),
        F.col("c_mktsegment").alias("plan_id"),
        F.date_add(F.lit("1995-01-01").cast("date"), (F.col("c_custkey") % 2000).cast("int"))
        .alias("enrolled_on"),
    )


def providers(spark: SparkSession, root: str) -> DataFrame:
    return read_table(spark, root, "supplier").select(
        F.col("s_suppkey").alias("provider_id"),
        F.col("s_name").alias("provider_name"),
        F.col("s_nationkey").alias("region"),
        (F.col("s_suppkey") % 5 < 3).alias("in_network"),
        specialty(F.col("s_suppkey")).alias("specialty"),
        rating(F.col("s_suppkey")).alias("rating"),
    )


def plans(spark: SparkSession, root: str) -> DataFrame:
    """The plans in use; the share refunded grows with the length of the plan's name."""
    return (
        read_table(spark, root, "customer")
        .select(F.col("c_mktsegment").alias("plan_id")).distinct()
        .withColumn("plan_rate", F.length("plan_id") / 20.0)
    )


def mapped_domain(spark: SparkSession, root: str, rows: DataFrame | None = None) -> Domain:
    """The mapped tables; ``rows`` are the treatments when they were written before."""
    rows = treatments(spark, root) if rows is None else rows
    return Domain(
        claims=claims(rows),
        network=network(rows),
        members=members(spark, root),
        providers=providers(spark, root),
        plans=plans(spark, root),
        ceiling=MAPPED_CEILING,
        event_code=MAPPED_EVENT,
    )


# --- attributes and places the parquet tables lack: fixed functions of the key -------------
def draw(key: Column, salt: int) -> Column:
    """A number from the digest of key and salt, so that attributes do not depend on each other."""
    digest = F.md5(F.concat_ws("-", key.cast("string"), F.lit(str(salt))))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")


def specialty(key: Column) -> Column:
    return F.concat(F.lit("Specialty "), draw(key, 11) % 3)


def rating(key: Column) -> Column:
    return (key * 7 % 51) / 10.0


def coordinates(key: Column, lat_step: int, lon_step: int) -> list[Column]:
    """A place within about four degrees; about every third key sits in one small town."""
    town = draw(key, 12) % 3 == 0
    lat = F.when(town, -23.5 + (key % 97) / 5000.0).otherwise(
        -25.5 + (key * lat_step % 10007) * 4.0 / 10007.0)
    lon = F.when(town, -46.6 + (key % 89) / 5000.0).otherwise(
        -48.6 + (key * lon_step % 10009) * 4.0 / 10009.0)
    return [lat.alias("lat"), lon.alias("lon")]


def provider_places(spark: SparkSession, root: str) -> DataFrame:
    """Providers with specialty, rating, accepted plans and a place."""
    key = F.col("s_suppkey")
    accepted = F.array_compact(F.array(*[
        F.when(draw(key, 20 + i) % (i + 2) == 0, F.lit(p)) for i, p in enumerate(PLAN_NAMES)]))
    return read_table(spark, root, "supplier").select(
        key.alias("provider_id"),
        F.col("s_name").alias("provider_name"),
        specialty(key).alias("specialty"),
        F.col("s_nationkey").alias("region"),
        (key % 5 < 3).alias("in_network"),
        rating(key).alias("rating"),
        (key % 20 < 7).alias("urgent"),
        F.when(key % 5 < 3, accepted).otherwise(F.array().cast("array<string>")).alias("plans"),
        *coordinates(key, 7919, 6101),
    )


def member_places(spark: SparkSession, root: str) -> DataFrame:
    """Members with an identity number, a plan and a place."""
    key = F.col("c_custkey")
    digits = F.lpad(key.cast("string"), 11, "0")
    dotted = F.concat(
        F.substring(digits, 1, 3), F.lit("."), F.substring(digits, 4, 3), F.lit("."),
        F.substring(digits, 7, 3), F.lit("-"), F.substring(digits, 10, 2))
    return read_table(spark, root, "customer").select(
        key.alias("member_id"),
        F.col("c_name").alias("member_name"),
        F.when(key % 2 == 0, dotted).otherwise(digits).alias("national_id"),
        F.col("c_mktsegment").alias("plan_name"),
        F.col("c_nationkey").alias("region"),
        *coordinates(key, 5003, 8009),
    )


# --- fixed values: the plans of the mapped data --------------------------------------------
PLAN_NAMES = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
