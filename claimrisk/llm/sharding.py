"""Placement by a weighted hash tree of regions, racks and shards.

Every node of the tree draws ln(u) / weight, where u is a hash of the document id and the node's
name; at each level the child with the greatest draw wins.  A child's chance is in proportion to
its weight, and a changed weight moves rows only into or out of that child's subtree.  Shards that
come later join as a region of their own, so that rows move into the new shard only.

Law ``key``: document id and tree alone decide.  Null ids draw as an empty name; repeated ids go
to the same shard; null texts have size 1 and the checksum of the empty text.  Slots number the
rows of a shard without gaps; they are counted in buckets by hash, so no task sees a whole shard.
Empty tables give empty results; further columns of the input are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from claimrisk.session import written

Tree = dict[int, dict[int, dict[int, float]]]  # region: rack: shard: weight
DRAWS = 2 ** 52
BUCKET_DIGITS = 3  # slots are counted in 16 ** 3 buckets a shard


def balanced(regions: int = 2, racks: int = 2, shards: int = 2) -> Tree:
    """A tree of equal weights, shards numbered in order."""
    return {r: {k: {(r * racks + k) * shards + s: 1.0 for s in range(shards)}
                for k in range(racks)} for r in range(regions)}


def grown(tree: Tree, weight: float = 1.0) -> Tree:
    """The tree with one more shard, in a region of its own."""
    last = max(s for racks in tree.values() for shards in racks.values() for s in shards)
    return tree | {max(tree) + 1: {0: {last + 1: weight}}}


def _weight(node) -> float:
    return sum(map(_weight, node.values())) if isinstance(node, dict) else float(node)


def placed(tree: Tree, key: Column) -> Column:
    """The shard of a key (string column)."""
    def descend(node, name: str, label: int) -> Column:
        if not isinstance(node, dict):
            return F.lit(label)
        children = {c: (n, f"{name}/{c}") for c, n in node.items() if _weight(n) > 0}
        if len(children) == 1:
            (label, (child, path)), = children.items()
            return descend(child, path, label)
        draws = [
            F.struct((F.ln((F.conv(F.substring(F.md5(F.concat(key, F.lit(path))), 1, 13), 16, 10)
                            .cast("double") + 1) / DRAWS) / _weight(child)).alias("draw"),
                     F.lit(c).alias("child"))
            for c, (child, path) in children.items()]
        best = F.greatest(*draws).getField("child")
        if not any(isinstance(child, dict) for child, _ in children.values()):
            return best
        branches = [(best == c, descend(child, path, c)) for c, (child, path) in children.items()]
        out = F.when(*branches[0])
        for condition, value in branches[1:]:
            out = out.when(condition, value)
        return out

    return descend(tree, "", 0).cast("int")


def assign(spark: SparkSession, docs: DataFrame, tree: Tree | None = None) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot and grown_shard of every document."""
    tree = tree or balanced()
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    text = F.coalesce("text", F.lit(""))
    rows = written(spark, docs.select(
        "doc_id",
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(F.encode(text, "utf-8")).alias("text_crc32"),
        placed(tree, key).alias("shard"),
        placed(grown(tree), key).alias("grown_shard"),
        F.substring(F.md5(key), 1, BUCKET_DIGITS).alias("bucket")), "placed")
    before = (
        rows.groupBy("shard", "bucket").count()
        .withColumn("before", F.coalesce(F.sum("count").over(
            Window.partitionBy("shard").orderBy("bucket")
            .rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        .select("shard", "bucket", "before"))
    within = Window.partitionBy("shard", "bucket").orderBy("doc_id", "text_crc32", "size")
    return (
        rows.withColumn("nth", F.row_number().over(within))
        .join(before, ["shard", "bucket"])
        .select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard",
                (F.col("before") + F.col("nth") - 1).cast("long").alias("slot"), "grown_shard"))
