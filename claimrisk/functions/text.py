"""Text as words and overlapping chunks, JVM-side."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CHUNK_WORDS = 100
OVERLAP_WORDS = 20


def normal_space(text: Column) -> Column:
    """Runs of white space as one blank, ends trimmed."""
    return F.trim(F.regexp_replace(text, r"\s+", " "))


def words(text: Column) -> Column:
    """Lower-case runs of letters and digits, in order."""
    spaced = F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " "))
    return F.filter(F.split(spaced, " "), lambda w: w != "")


def chunks(docs: DataFrame, doc: str = "doc_id", text: str = "text", size: int = CHUNK_WORDS,
           overlap: int = OVERLAP_WORDS) -> DataFrame:
    """(doc, chunk, words): windows of ``size`` words that share ``overlap`` words.

    The whole text is covered; every chunk but a document's first starts after its predecessor.
    """
    step = size - overlap
    last = F.greatest(F.size("words") - overlap - 1, F.lit(0))
    starts = F.posexplode(F.sequence(F.lit(0), last, F.lit(step))).alias("chunk", "start")
    return (
        docs.select(doc, words(F.col(text)).alias("words")).filter(F.size("words") > 0)
        .select(doc, "words", starts)
        .select(doc, "chunk", F.slice("words", F.col("start") + 1, F.lit(size)).alias("words"))
    )
