"""Top-k retrieval for a battery of questions, and checks of the answers.

Chunks meet the battery inside their task; only the k best per question leave it, so neither
chunk-question pairs nor common words are ever shuffled.  Terms are pruned by thresholds: once a task
has k answers for a question, its common terms that together weigh less than the k-th best cannot
make an answer by themselves, so only chunks with one of the other terms are scored.  The result is
that of scoring every chunk.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimrisk.functions.text import words
from claimrisk.operators.ranking import first_per_group

BATTERY = 500          # questions scored in one pass; larger batteries take several passes
BATTERY_TERMS = 20_000  # distinct words of the questions of one pass
CELLS_AT_ONCE = 4_000_000  # size of the chunk-by-term matrix scored by one product


def _best(found: pd.DataFrame, k: int, order: list[str]) -> pd.DataFrame:
    """The k best rows per question under the total order (score down, then ``order``)."""
    found = found.sort_values(["question", "score", *order], ascending=[True, False, *[True] * len(order)])
    return found.groupby("question", sort=False).head(k)


def _candidates(scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, question) of all scores that reach the k-th best of their question, ties included."""
    if scores.shape[0] > k:
        cut = np.partition(scores, scores.shape[0] - k, axis=0)[scores.shape[0] - k]
    else:
        cut = np.full(scores.shape[1], -np.inf)
    return np.nonzero(scores >= cut)


def term_weights(chunked: DataFrame, vocabulary: DataFrame, weighted: bool = True) -> DataFrame:
    """(term, weight) for the terms of the questions: thousandths of ln(chunks / chunks with it)."""
    if not weighted:
        return vocabulary.withColumn("weight", F.lit(1).cast("long"))
    total = chunked.count()
    frequency = (
        chunked.select(F.explode(F.array_distinct("words")).alias("term"))
        .join(F.broadcast(vocabulary), "term").groupBy("term").agg(F.count("*").alias("df"))
    )
    return frequency.select(
        "term", F.floor(1000 * F.log(F.lit(float(total)) / F.col("df"))).cast("long").alias("weight"))


def question_slices(questions: DataFrame, key: str, size: Column) -> list[DataFrame]:
    """The battery in slices of about BATTERY questions and BATTERY_TERMS words each."""
    total = questions.agg(F.count("*").alias("n"), F.sum(size).alias("terms")).first()
    n = max(ceil(total["n"] / BATTERY), ceil((total["terms"] or 0) / BATTERY_TERMS), 1)
    if n == 1:
        return [questions]
    part = F.pmod(F.xxhash64(key), F.lit(n))
    return [questions.filter(part == i) for i in range(n)]


def term_topk(chunked: DataFrame, questions: DataFrame, k: int, key: str = "item_id",
              weighted: bool = True) -> DataFrame:
    """The k chunks of each question with the highest sum of weights over shared distinct terms."""
    size = F.size(F.array_distinct(words(F.col("text"))))
    passes = [_term_pass(chunked, s, k, key, weighted) for s in question_slices(questions, key, size)]
    found = passes[0]
    for more in passes[1:]:
        found = found.unionByName(more)
    return first_per_group(
        found, ["question"], [F.col("score").desc(), "doc_id", "chunk"], k,
    ).withColumnRenamed("question", key)


class Battery:
    """The weighted terms of some questions."""

    def __init__(self, local: pd.DataFrame):
        local = local[local["weight"] > 0]
        self.terms, term = np.unique(local["term"].to_numpy(dtype=object).astype(str), return_inverse=True)
        self.questions, question = np.unique(local["question"].to_numpy(), return_inverse=True)
        weight = local["weight"].to_numpy(dtype=np.float64)
        order = np.lexsort((weight, question))  # by question, the lightest term first
        question, weight, term = question[order], weight[order], term[order]
        starts = np.searchsorted(question, np.arange(len(self.questions)))
        upto = np.cumsum(weight)
        # what a question's terms weigh up to and with each of them
        self.light = upto - np.repeat(np.concatenate([[0.0], upto])[starts], np.diff([*starts, len(question)]))
        self.question, self.weight, self.term = question, weight, term
        self.pairs = 0  # of chunks and questions that were scored

    def _expanded(self, row: np.ndarray, term: np.ndarray, which: np.ndarray):
        """(row, question, weight) of every term of a row and question that has it, among some entries."""
        entries = np.flatnonzero(which)
        entries = entries[np.argsort(self.term[entries], kind="stable")]
        first = np.searchsorted(self.term[entries], np.arange(len(self.terms) + 1))
        many = (first[1:] - first[:-1])[term]
        at = entries[np.repeat(first[:-1][term] - np.cumsum(many) + many, many) + np.arange(many.sum())]
        return np.repeat(row, many), self.question[at], self.weight[at]

    def scored(self, row: np.ndarray, term: np.ndarray, rows: int, least: np.ndarray):
        """row, question and score of all pairs that can reach ``least``, the k-th best of each question.

        A chunk may hold a term several times; it counts once.
        """
        n = len(self.questions)
        distinct = np.unique(row * np.int64(len(self.terms)) + term)
        row, term = np.divmod(distinct, max(1, len(self.terms)))
        heavy = self.light >= least[self.question]  # without these terms nothing reaches it
        at, question, _ = self._expanded(row, term, heavy)
        wanted = np.zeros(rows * n, bool)
        wanted[at * n + question] = True
        self.pairs += int(wanted.sum())
        some = np.zeros(rows, bool)
        some[at] = True
        keep = some[row]
        at, question, weight = self._expanded(row[keep], term[keep], np.ones(len(self.term), bool))
        code = at * n + question
        keep = wanted[code]
        total = np.bincount(code[keep], weight[keep], rows * n)
        hit = np.flatnonzero(wanted)
        hit = hit[total[hit] >= np.maximum(least[hit % max(1, n)], 1)]
        return hit // max(1, n), hit % max(1, n), total[hit].astype(np.int64)


def _term_pass(chunked, questions, k, key, weighted):
    asked = questions.select(
        F.col(key).alias("question"), F.explode(F.array_distinct(words(F.col("text")))).alias("term"))
    # The vocabulary of one slice: at most BATTERY question texts.
    weights = term_weights(chunked, asked.select("term").distinct(), weighted)
    local = asked.join(weights, "term").select("question", "term", "weight").toPandas()
    battery = Battery(local)
    terms = battery.terms
    at_once = max(1, CELLS_AT_ONCE // max(1, len(battery.questions)))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = pa.array(terms, pa.string())
        best, least = [], np.zeros(len(battery.questions))
        for batch in batches:
            for start in range(0, batch.num_rows, at_once):
                part = batch.slice(start, at_once)
                lists = part.column("words")
                row_of = np.repeat(np.arange(len(lists)), pc.list_value_length(lists).to_numpy())
                term = pc.index_in(lists.flatten(), known).fill_null(-1).to_numpy()
                row, question, scores = battery.scored(row_of[term >= 0], term[term >= 0], len(lists), least)
                found = pd.DataFrame({
                    "question": question,
                    "doc_id": part.column("doc_id").to_numpy()[row],
                    "chunk": part.column("chunk").to_numpy()[row],
                    "score": scores})
                best = [_best(pd.concat([*best, found]), k, ["doc_id", "chunk"])]
                kth = best[0].groupby("question", sort=False)["score"].agg(["size", "min"])
                kth = kth[kth["size"] >= k]["min"]
                least[kth.index.to_numpy(dtype=np.int64)] = kth.to_numpy()
        for found in best:
            found = found.assign(question=battery.questions[found["question"].to_numpy(dtype=np.int64)])
            yield pa.RecordBatch.from_pandas(found, preserve_index=False)

    if not len(terms):
        return chunked.sparkSession.createDataFrame(
            [], "question bigint, doc_id bigint, chunk int, score bigint")
    return chunked.select("doc_id", "chunk", "words").mapInArrow(
        score, "question bigint, doc_id bigint, chunk int, score bigint")


def vector_topk(vectors: DataFrame, questions: DataFrame, k: int) -> DataFrame:
    """The k vectors most similar by cosine to each question vector (vec_id, embedding)."""
    passes = [_vector_pass(vectors, s, k) for s in question_slices(questions, "vec_id", F.size("embedding"))]
    found = passes[0]
    for more in passes[1:]:
        found = found.unionByName(more)
    return first_per_group(found, ["question"], [F.col("score").desc(), "vec_id"], k)


def _unit(rows) -> np.ndarray:
    m = np.vstack([np.asarray(r, dtype=np.float64) for r in rows])
    return m / np.maximum(np.linalg.norm(m, axis=1, keepdims=True), 1e-300)


def _vector_pass(vectors, questions, k):
    asked = questions.select("vec_id", "embedding").toPandas()
    ids, matrix = asked["vec_id"].to_numpy(), _unit(asked["embedding"]).T

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        best = []
        for pdf in batches:
            if not len(pdf):
                continue
            scores = np.round(_unit(pdf["embedding"]) @ matrix, 6)
            row, question = _candidates(scores, k)
            found = pdf[["vec_id"]].iloc[row].reset_index(drop=True)
            found["question"] = ids[question]
            found["score"] = scores[row, question]
            best = [_best(pd.concat([*best, found]), k, ["vec_id"])]
        for found in best:
            yield found[["question", "vec_id", "score"]]
    return vectors.select("vec_id", "embedding").mapInPandas(
        score, "question bigint, vec_id bigint, score double")


def check_answers(answers: DataFrame, expectations: DataFrame, key: str = "item_id") -> DataFrame:
    """Per run and question: whether all required patterns and no forbidden one match.

    ``answers``: run, key, answer; ``expectations``: key, kind ('required' or 'forbidden'), pattern.
    """
    hit = F.expr("answer RLIKE pattern")
    meets = F.when(F.col("kind") == "required", hit).otherwise(~hit)
    return answers.join(expectations, key).groupBy("run", key).agg(
        F.bool_and(F.coalesce(meets, F.lit(False))).alias("passed"))


def pass_rates(checked: DataFrame) -> DataFrame:
    """Questions, passes and pass rate per run."""
    return checked.groupBy("run").agg(
        F.count("*").alias("questions"), F.count_if("passed").alias("passed"),
        (F.count_if("passed") / F.count("*")).alias("pass_rate"))
