"""Streams against the batch form of the same result."""

import datetime as dt
import os
from collections import defaultdict
from dataclasses import replace

from pyspark.sql import functions as F

from claimrisk.functions.columns import band, value_at_risk, vector_columns
from claimrisk.operators import model
from claimrisk.plans import features, lake
from claimrisk.plans.sqlparts import SCORE_SQL
from claimrisk.session import work_dir
from claimrisk.sources import domain
from claimrisk.streaming.arrivals import score_arrivals
from claimrisk.streaming.burst import close_input, hourly_counts, open_input, with_closing
from claimrisk.streaming.scoring import append_files, claim_stream, scored_stream


def run(spark, stream, name, checkpoint=None, path=None):
    path = path or work_dir(spark, name)
    append_files(stream, path, checkpoint or work_dir(spark, f"{name}-cp")).awaitTermination()
    return spark.read.schema(stream.schema).parquet(path)


CUT = "1999-06-01"


def held_out(spark, root):
    """History before a day, staged; the claims from that day on."""
    d = lake.silver(spark, root)
    published = features.stage(spark, replace(d, claims=d.claims.filter(F.col("req_date") < CUT)))
    return d, published, d.claims.filter(F.col("req_date") >= CUT)


def test_new_claims_count_with_their_history(spark, root):
    d, published, new = held_out(spark, root)
    got = {r.claim_id: r for r in features.feature_table(
        spark, replace(d, claims=new), published, arriving=True).collect()}
    history, documents = defaultdict(list), set()
    for r in d.claims.filter(F.col("req_date") < CUT).collect():
        history[r.member_id, r.provider_id].append(r.proc_date)
        documents.add(r.document)
    seen = set()
    for r in new.collect():
        days = [(r.proc_date - p).days for p in history[r.member_id, r.provider_id]]
        assert got[r.claim_id].pair_claims_30d == 1 + sum(0 <= n <= 30 for n in days)
        assert got[r.claim_id].repeated_document == int(r.document in documents)
        seen.add(got[r.claim_id].repeated_document)
    assert len(got) == new.count() > 0 and seen == {0, 1}


def test_stream_scores_equal_batch_scores(spark, root):
    d, published, new = held_out(spark, root)
    path, schema = lake.location(spark, root, "treatments")
    arriving = domain.claims(claim_stream(spark, path, schema, files_per_batch=2)).filter(
        F.col("req_date") >= CUT)
    got = run(spark, scored_stream(
        spark, arriving, d, published, F.expr(SCORE_SQL), threshold=0.3), "scores")
    batch = features.feature_table(spark, replace(d, claims=new), published, arriving=True).select(
        "claim_id", F.col("amount").alias("a"), *vector_columns()).withColumn(
        "score", F.expr(SCORE_SQL)).select(
        "claim_id", "score", band(F.col("score"), 0.3).alias("priority"),
        value_at_risk(F.col("score"), F.col("a")).alias("value_at_risk"))
    assert got.count() == batch.count() > 0 and got.exceptAll(batch).isEmpty()


def test_stream_scores_with_a_fitted_model(spark, root):
    d, published, new = held_out(spark, root)
    fitted = model.fit_booster(lake.gold(spark, root), maxIter=2, maxDepth=2)
    path, schema = lake.location(spark, root, "treatments")
    arriving = domain.claims(claim_stream(spark, path, schema)).filter(F.col("req_date") >= CUT)
    got = run(spark, scored_stream(spark, arriving, d, published, model=fitted), "model_scores")
    rows = features.feature_table(spark, replace(d, claims=new), published, arriving=True)
    batch = model.score(fitted, rows).select("claim_id", F.col("score").alias("expected"))
    gap = got.join(batch, "claim_id").agg(F.max(F.abs(F.col("score") - F.col("expected")))).first()[0]
    assert got.count() == new.count() and gap < 1e-9


def test_new_files_are_scored_once(spark, root):
    d, published = lake.silver(spark, root), lake.staged(spark, root)
    source, out, checkpoint = (work_dir(spark, n) for n in ("in", "out", "cp"))
    rows = d.claims.orderBy("claim_id").limit(30)
    rows.limit(10).coalesce(1).write.parquet(source)

    def go():
        stream = claim_stream(spark, source, rows.schema)
        return run(spark, scored_stream(spark, stream, d, published, F.expr(SCORE_SQL)), "x", checkpoint, out)
    first = go().count()
    rows.coalesce(1).write.mode("append").parquet(source)
    assert first == 10 and go().count() == 40


def test_hourly_counts_drop_late_rows_and_keep_closed_windows(spark):
    t0 = dt.datetime(2024, 1, 1, 12, 0)
    source, out, checkpoint = (work_dir(spark, n) for n in ("ein", "eout", "ecp"))

    def arrive(rows):
        spark.createDataFrame(
            [(u, t0 + dt.timedelta(minutes=m)) for u, m in rows], "user_id long, ts timestamp",
        ).coalesce(1).write.mode("append").parquet(source)
        events = spark.readStream.schema("user_id long, ts timestamp").parquet(source)
        return run(spark, hourly_counts(events, "user_id"), "e", checkpoint, out)
    arrive([(1, 0), (1, 30), (2, 10)])
    arrive([(1, 300)])
    got = arrive([(2, 11), (1, 700)])   # minute 11 lies far behind the watermark
    counts = {(r["user_id"], r["window_start"]): r["n"] for r in got.collect()}
    assert counts[(1, t0)] == 2 and counts[(2, t0)] == 1
    assert counts[(1, t0 - dt.timedelta(minutes=55))] == 1


def arrive_in_parts(spark, root, rows, parts, again=False):
    """Scores of claims that arrive part by part; again: the last batch is run a second time."""
    d = lake.silver(spark, root)
    published = lake.staged(spark, root)
    source, out, state, checkpoint = (work_dir(spark, n) for n in ("ain", "aout", "astate", "acp"))

    def go():
        arriving = spark.readStream.schema(d.claims.schema).parquet(source)
        score_arrivals(spark, arriving, d, published, out, state, checkpoint, F.expr(SCORE_SQL),
                       0.3).awaitTermination()

    for part in parts:
        rows.where(F.col("claim_id").isin(part)).coalesce(1).write.mode("append").parquet(source)
        go()
    if again:
        for n in (str(len(parts) - 1), f".{len(parts) - 1}.crc"):
            path = f"{checkpoint}/commits/{n}"
            if os.path.exists(path):
                os.unlink(path)
        go()
    found = spark.read.parquet(out).collect()
    assert len({r.claim_id for r in found}) == len(found)
    return {r.claim_id: (r.pair_claims_30d, r.repeated_document) for r in found}


def fresh_claims(spark, root):
    """Six claims of a pair and documents that the history does not know."""
    like = lake.silver(spark, root).claims.limit(1).drop("claim_id", "provider_id", "document", "proc_date", "req_date")
    day = dt.date(2005, 1, 1)
    own = [(1, -5, "new-a", 0, 40), (2, -5, "new-a", 3, 41), (3, -5, "new-b", 36, 42), (4, -6, "new-a", 36, 42),
           (5, -5, None, 34, 43), (6, -5, None, 2, 44)]
    rows = spark.createDataFrame(
        [(c, p, x, day + dt.timedelta(a), day + dt.timedelta(r)) for c, p, x, a, r in own],
        "claim_id long, provider_id long, document string, proc_date date, req_date date")
    return rows.crossJoin(like).select(lake.silver(spark, root).claims.columns)


PLACES = [(-5, 0), (-5, 3), (-5, 36), (-6, 36), (-5, 34), (-5, 2)]  # provider and day of claims 1 to 6
REPEATED = {1: 0, 2: 1, 3: 0, 4: 1, 5: 0, 6: 0}


def test_arrivals_count_for_later_arrivals_whatever_the_batches(spark, root):
    rows = fresh_claims(spark, root)
    want = {}
    for c, (provider, day) in enumerate(PLACES, 1):
        before = [a for p, a in PLACES[:c - 1] if p == provider and day - 30 <= a <= day]
        want[c] = 1 + len(before), REPEATED[c]
    assert want[1] == (1, 0) and want[2] == (2, 1)
    for parts in ([[1, 2, 3, 4, 5, 6]], [[1], [2], [3, 4], [5, 6]], [[1, 2, 3], [4, 5, 6]]):
        assert arrive_in_parts(spark, root, rows, parts) == want


def test_a_batch_that_is_run_again_counts_once(spark, root):
    rows = fresh_claims(spark, root)
    parts = [[1, 2, 3], [4, 5, 6]]
    assert arrive_in_parts(spark, root, rows, parts, again=True) == arrive_in_parts(spark, root, rows, parts)


def test_closing_an_input_emits_open_windows_once(spark):
    t0 = dt.datetime(2024, 1, 1, 12, 0)
    source, out, checkpoint, closing = (work_dir(spark, n) for n in ("cin", "cout", "ccp", "cend"))
    rows = [(u, t0 + dt.timedelta(minutes=m)) for u, m in [(1, 0), (1, 30), (2, 300), (None, 301)]]
    schema = "user_id long, ts timestamp"
    events = spark.createDataFrame(rows, schema)
    events.write.parquet(source)
    open_input(spark, events, closing)

    def go():
        stream = with_closing(spark, spark.readStream.schema(schema).parquet(source), closing)
        return run(spark, hourly_counts(stream, "user_id"), "c", checkpoint, out).collect()
    go()
    close_input(spark, events, closing)
    for _ in range(2):
        got = go()
    counts = {(r["user_id"], r["window_start"]): r["n"] for r in got}
    assert len(counts) == len(got) and sum(counts.values()) == 12 * len(rows)
    assert counts[(1, t0)] == 2 and counts[(2, t0 + dt.timedelta(minutes=300))] == 1


def test_windows_that_start_in_one_hour_share_a_row_of_the_state(spark):
    t0 = dt.datetime(2024, 1, 1, 12, 0)
    source, out, checkpoint, closing = (work_dir(spark, n) for n in ("sin", "sout", "scp", "send"))
    rows = [(u, t0 + dt.timedelta(minutes=m, seconds=s)) for u, m, s in [
        (1, 0, 0), (1, 0, 0), (1, 4, 59), (1, 59, 59), (1, 60, 0), (1, 61, 7), (2, 55, 0), (2, 119, 59), (None, 3, 0)]]
    rows.append((1, None))
    schema = "user_id long, ts timestamp"
    events = spark.createDataFrame(rows, schema).coalesce(1)
    events.write.parquet(source)
    open_input(spark, events, closing)

    def go():
        stream = with_closing(spark, spark.readStream.schema(schema).parquet(source), closing)
        query = append_files(hourly_counts(stream, "user_id"), out, checkpoint)
        query.awaitTermination()
        return [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress]
    held = max(go())
    close_input(spark, events, closing)
    go()
    want = defaultdict(int)
    for u, t in rows:
        if t is not None:
            first = t - dt.timedelta(minutes=t.minute % 5, seconds=t.second)
            for k in range(12):
                want[u, first - dt.timedelta(minutes=5 * k)] += 1
    got = spark.read.parquet(out).collect()
    assert {(r.user_id, r.window_start): r.n for r in got} == want and len(got) == len(want)
    assert {r.window_end - r.window_start for r in got} == {dt.timedelta(hours=1)}
    assert 0 < held <= 2 * len({(u, t.hour) for u, t in rows if t})   # one row a window held 56 before
