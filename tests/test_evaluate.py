"""Scores, thresholds and splits against brute force."""

import datetime as dt
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from claimrisk.operators import evaluate
from claimrisk.schemas import AFTER_DECISION, FEATURES


def frame(spark, rows):
    return spark.createDataFrame(rows, "score double, label int, amount double")


def brute(rows):
    """Average precision and ROC AUC by definition."""
    pos = sum(r[1] for r in rows)
    neg = len(rows) - pos
    ap, tp, n = 0.0, 0, 0
    for s in sorted({r[0] for r in rows}, reverse=True):
        group = [r for r in rows if r[0] == s]
        gained = sum(r[1] for r in group)
        tp, n = tp + gained, n + len(group)
        ap += gained / pos * tp / n
    wins = sum((p[0] > q[0]) + 0.5 * (p[0] == q[0]) for p in rows if p[1] for q in rows if not q[1])
    return ap, wins / (pos * neg)


def test_average_precision_with_ties(spark):
    r = evaluate.ranking_quality(
        spark, frame(spark, [(.9, 1, 1.), (.5, 1, 1.), (.5, 0, 1.), (.1, 0, 1.)])).first()
    assert r["average_precision"] == pytest.approx(0.8333333333)
    assert r["roc_auc"] == pytest.approx(0.875)


@pytest.mark.parametrize("buckets", [256, 8])
@pytest.mark.parametrize("distinct", [7, 10**9])
def test_ranking_quality_matches_brute_force(spark, buckets, distinct):
    rng = random.Random(distinct)
    rows = [(rng.randrange(distinct) / distinct, int(rng.random() < 0.3), 1.0) for _ in range(300)]
    r = evaluate.ranking_quality(
        spark, frame(spark, rows), buckets=buckets).first()
    ap, auc = brute(rows)
    assert r["average_precision"] == pytest.approx(ap, abs=1e-9)
    assert r["roc_auc"] == pytest.approx(auc, abs=1e-9)


def test_no_positives_gives_null(spark):
    r = evaluate.ranking_quality(spark, frame(spark, [(.2, 0, 1.), (.3, 0, 1.)])).first()
    assert r["average_precision"] is None and r["roc_auc"] is None


def test_cuts_are_those_of_a_float_range():
    cuts = evaluate.threshold_cuts()
    assert cuts == list(np.arange(0.05, 0.96, 0.05)) and len(cuts) == 19
    assert cuts[2] == 0.15000000000000002


def test_sweep_matches_brute_force(spark):
    rng = random.Random(3)
    rows = [(rng.choice([0.0, 0.15, 0.3, 0.55, 0.999, rng.random()]), int(rng.random() < 0.2),
             round(rng.random() * 900, 2)) for _ in range(500)]
    got = evaluate.threshold_sweep(frame(spark, rows)).orderBy("threshold").collect()
    assert len(got) == 19
    pos = sum(r[1] for r in rows)
    for cut, r in zip(evaluate.threshold_cuts(), got):
        hit = [x for x in rows if x[0] >= cut]
        tp = sum(x[1] for x in hit)
        saved = sum(x[2] for x in hit if x[1])
        assert r["threshold"] == round(cut, 2) and r["flagged"] == len(hit)
        assert r["precision"] == (tp / len(hit) if hit else 0.0) and r["recall"] == tp / pos
        assert r["value_saved"] == pytest.approx(saved, abs=1e-6)
        assert r["value_lost"] == pytest.approx(sum(x[2] for x in rows if x[1]) - saved, abs=1e-6)
        assert r["net_benefit"] == pytest.approx(saved - 40 * len(hit), abs=0.006)


def test_best_threshold_takes_the_lowest_on_ties(spark):
    rows = [(0.99, 1, 100.0)] * 2
    assert evaluate.best_threshold(evaluate.threshold_sweep(frame(spark, rows))).first()["threshold"] == 0.05


def test_time_split_matches_the_interpolated_quantile(spark):
    days = [dt.date(2025, 1, 1) + dt.timedelta(days=random.Random(i).randrange(400)) for i in range(97)]
    rows = spark.createDataFrame([(i, d) for i, d in enumerate(days)], "claim_id int, req_date date")
    cut = pd.Series(pd.to_datetime(days)).quantile(0.8)
    train, test = evaluate.time_split(rows)
    assert train.count() == sum(pd.Timestamp(d) <= cut for d in days)
    assert train.count() + test.count() == 97


def test_capacity_cut(spark):
    day = dt.date(2025, 1, 1)
    rows = spark.createDataFrame(
        [(i, day, s) for i, s in enumerate([.9, .8, .8, .1])] + [(9, dt.date(2025, 1, 2), .2)],
        "claim_id int, req_date date, score double")
    got = {r["req_date"]: (r["kept"], r["implied_threshold"]) for r in evaluate.capacity_cut(rows, 2).collect()}
    assert got == {day: (2, .8), dt.date(2025, 1, 2): (1, .2)}


def test_rule_quality_counts_null_as_not_flagged(spark):
    rows = spark.createDataFrame([(None, 1), (2.0, 1), (2.0, 0), (0.0, 1)], "amount double, label int")
    r = evaluate.rule_quality(rows, F.col("amount") > 1).first()
    assert (r["tp"], r["fp"], r["fn"]) == (1, 1, 2)
    assert (r["precision"], r["recall"]) == (0.5, 1 / 3)


def test_leak_guard():
    evaluate.assert_no_leak(FEATURES, AFTER_DECISION)
    with pytest.raises(ValueError):
        evaluate.assert_no_leak([*FEATURES, "status"], AFTER_DECISION)


def test_leakage_audit(spark):
    rows = spark.createDataFrame([(1, 1.0), (0, 0.0), (1, None), (0, 0.0)], "label int, x double")
    r = evaluate.leakage_audit(rows, {"x": F.col("x")}).first()
    assert r["correlation"] == pytest.approx(1.0) and r["null_rate"] == 0.25


def test_ranking_quality_of_billions(spark, monkeypatch):
    n = 4 * 10**9
    totals = spark.createDataFrame(
        [(0.9, n, n, 0, 0), (0.1, n, 0, n, n)],
        "score double, n long, tp long, n_above long, tp_above long")
    monkeypatch.setattr(evaluate, "score_totals", lambda *a, **k: totals)
    r = evaluate.ranking_quality(spark, totals).first()
    assert (r["rows"], r["average_precision"], r["roc_auc"]) == (2 * n, 1.0, 1.0)
    monkeypatch.setattr(evaluate, "score_totals", lambda *a, **k: totals.withColumns({
        "tp": n - F.col("tp"), "tp_above": F.lit(0)}))
    assert evaluate.ranking_quality(spark, totals).first()["roc_auc"] == 0.0
