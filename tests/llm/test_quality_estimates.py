"""Robust estimates of groups of any size against exact concentration steps."""

import numpy as np
import pytest

from claimrisk.llm import quality
from tests.llm.test_operators import prose

P = quality.P


def vectors(spark, groups):
    rows = [(f"={name}", "=s", x.tolist()) for name, xs in groups.items() for x in xs]
    return spark.createDataFrame(rows, "group_lang string, group_source string, x array<double>").repartition(3)


def exact(xs, start):
    """Concentration steps on the whole data from one start, until the determinant stands."""
    best = None
    mean, cov = start
    while True:
        root = np.linalg.inv(np.linalg.cholesky(quality.floored(cov)))
        distance = (((xs - mean) @ root.T) ** 2).sum(1)
        near = xs[np.argsort(distance, kind="stable")[:int(quality.SUPPORT * len(xs))]]
        mean, cov = near.mean(0), np.cov(near.T, bias=True)
        spread = np.linalg.slogdet(quality.floored(cov))[1]
        if best is not None and spread >= best - 1e-6:
            return best
        best = spread


def test_estimates_have_the_least_determinant(spark):
    r = np.random.default_rng(4)
    groups = {}
    for g in range(4):
        clean = r.normal(size=(300, P)) @ r.normal(size=(P, P)) * 2
        groups[f"g{g}"] = np.concatenate([clean, r.normal(size=(60, P)) + 30 * r.normal(size=P)])
    found, steps = quality.concentrated(spark, vectors(spark, groups))
    assert steps > 1
    for row in found.collect():
        xs = groups[row.group_lang[1:]]
        starts = [(np.median(xs, 0), np.diag((np.median(np.abs(xs - np.median(xs, 0)), 0) * 1.4826) ** 2)),
                  (xs.mean(0), np.cov(xs.T, bias=True))]
        for seed in range(20):  # and from random subsets
            some = xs[np.random.default_rng(seed).choice(len(xs), 40, replace=False)]
            starts.append((some.mean(0), np.cov(some.T, bias=True)))
        least = min(exact(xs, s) for s in starts)
        assert row.spread <= least + 0.05  # distances are compared by bins
        assert np.abs(np.array(row["mean"]) - xs[:300].mean(0)).max() < 1.5


def test_floors_are_floors():
    cov = np.diag(np.square(quality.FLOORS) * [4, 9, 1, 0.25, 0])
    assert np.allclose(np.diag(quality.floored(cov)), np.square(quality.FLOORS) * [4, 9, 1, 1, 1])
    assert np.allclose(quality.floored(np.zeros((P, P))), np.diag(np.square(quality.FLOORS)))


@pytest.mark.parametrize("size", [1, 4, 30, 49, 50, 51])
def test_one_rule_for_groups_of_all_sizes(spark, size):
    """Clean documents of a small source are kept and its junk goes, as in a large one."""
    rows = [(i, prose(100 + 7 * i % 200, 100 + i), "en", "large") for i in range(150)]
    rows += [(1000 + i, prose(100 + 9 * i % 200, 700 + i), "en", "small") for i in range(size)]
    rows += [(2000 + i, " ".join(w + "%%%" for w in prose(80, i).split()), "en", s)
             for i, s in enumerate(["small"] + ["large"] * 10)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = {r.doc_id: r.kept for r in quality.verdicts(spark, df).collect()}
    assert all(got[i] for i in got if i < 2000) and not any(got[i] for i in got if i >= 2000)
