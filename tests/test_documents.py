"""Elements, cells, chunks, retrieval and dated rules."""

import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from claimrisk.functions import html, payload, text
from claimrisk.operators import retrieval, rules
from tests.html_reference import parse

PAGE = """<!DOCTYPE html><html><head><title>t</title><style>p{}</style><script>var a="<p>x</p>";</script></head>
<body><nav><ul><li>Home</li><li>About</li></ul></nav><h1>Policy &amp; rules</h1><h2>Section 1</h2>
<p>First<br>part <b>bold</b><p>Second</p><ul><li>one</li></ul>
<table><tr><th>Group</th><th>Basic</th><th>Plus</th></tr>
<tr><td>Braces</td><td>not covered</td><td>120 days</td></tr><tr><td> Crown </td><td>300 days</td><td></td></tr></table>
<footer>End <p>page 1</p></footer></body></html>"""


def elements(spark, pages):
    """(type, content) of every element of every page, by the column expressions."""
    rows = html.element_rows(spark.createDataFrame(pages, "page_id long, html string").repartition(3))
    out = {k: [] for k, _ in pages}
    for r in rows.orderBy("page_id", "position").collect():
        assert r.position == len(out[r.page_id])
        out[r.page_id].append((r.type, r.content))
    return out


def test_elements_in_order(spark):
    found = elements(spark, [(1, PAGE), (2, None), (3, "plain"), (4, "")])
    got = found[1]
    assert got[:5] == [
        ("page_header", "Home About"), ("title", "Policy & rules"), ("section_header", "Section 1"),
        ("text", "First part bold"), ("text", "Second")]
    assert got[5] == ("text", "one") and got[6][0] == "table" and got[-1] == ("page_footer", "End page 1")
    assert found[2] == found[4] == [] and found[3] == [("text", "plain")]


BITS = ["<p>", "</p>", "<nav>", "</nav>", "<table>", "</table>", "<tr>", "<td>", "</td>", '<th colspan="2">', "text",
        "  ", "a&amp;b &eacute;&#65;&#x1F600;&nbsp;&bogus;", "<br>", "<b>", "</b>", "<head>", "</head>", "<template>",
        "</template>", "<h1>", "</h1>", "<!-- c -->", "<script>x<p></script>", "<div class='a>b'>", "</div>", "<footer>"]


def test_elements_match_a_parser(spark, root):
    rng = random.Random(3)
    pages = [(i, "".join(rng.choice(BITS) for _ in range(rng.randrange(1, 40)))) for i in range(300)]
    pages += [(1000 + r.page_id, r.html) for r in spark.read.parquet(f"{root}/pages.parquet").collect()]
    found = elements(spark, pages)
    for key, page in pages:
        assert found[key] == parse(page), page


def test_pages_without_ends_are_cut_in_linear_time(spark):
    import time
    pages = [(1, "<p " * 50_000), (2, '<p a="' * 50_000), (3, "<!-- " * 50_000), (4, "<" * 100_000),
             (5, "<script>" * 30_000), (6, "<table><tr><td>x" * 2_000)]
    elements(spark, pages[:1])
    start = time.time()
    assert elements(spark, pages)[6][0][0] == "table"
    assert time.time() - start < 30


def test_cells_keep_row_and_column(spark):
    pages = spark.createDataFrame([(1, PAGE)], "page_id long, html string")
    tables = html.element_rows(pages).filter("type = 'table'")
    cells = {(r["row_label"], r["column_label"]): r["value"] for r in html.table_cells(tables, ["page_id"]).collect()}
    assert cells[("Braces", "Basic")] == "not covered" and cells[("Braces", "Plus")] == "120 days"
    assert cells[("Crown", "Basic")] == "300 days" and cells[("Crown", "Plus")] == ""


def test_cells_that_span_rows_and_columns(spark):
    page = """<table><tr><th>Group<th colspan=2>Days</th></tr></table>
      <table><tr><th>a</th><th colspan="2">b</th><th>c</th></tr>
      <tr><td rowspan='3'>x</td><td>1</td><td rowspan=2>2</td><td>3</td></tr><tr><td>4</td><td>5</td></tr>
      <tr><td colspan=3>6</td></tr></table>"""
    tables = html.element_rows(spark.createDataFrame([(1, page)], "page_id long, html string")).where(
        "type = 'table' AND position = 1")
    got = {(r.row, r.col): (r.row_label, r.column_label, r.value)
           for r in html.table_cells(tables, ["page_id"]).collect()}
    assert got == {
        (0, 0): ("x", "a", "x"), (0, 1): ("x", "b", "1"), (0, 2): ("x", "b", "2"), (0, 3): ("x", "c", "3"),
        (1, 0): ("x", "a", "x"), (1, 1): ("x", "b", "4"), (1, 2): ("x", "b", "2"), (1, 3): ("x", "c", "5"),
        (2, 0): ("x", "a", "x"), (2, 1): ("x", "b", "6"), (2, 2): ("x", "b", "6"), (2, 3): ("x", "c", "6")}


def test_elements_as_json_document(spark):
    pages = spark.createDataFrame([(1, PAGE)], "page_id long, html string")
    listed = html.element_rows(pages).groupBy("page_id").agg(F.collect_list(F.struct(
        "type", "content")).alias("elements"))
    doc = listed.select(F.parse_json(F.to_json(F.struct(F.struct("elements").alias("document")))).alias("doc"))
    doc.createOrReplaceTempView("one_doc")
    rows = spark.sql("""SELECT el:type::string AS type, el:content::string AS content FROM one_doc
        LATERAL VIEW explode(CAST(doc:document:elements AS ARRAY<VARIANT>)) t AS el""")
    assert rows.filter("type = 'section_header'").first()["content"] == "Section 1"


@pytest.mark.parametrize("n", [1, 5, 10, 11, 18, 19, 57])
def test_chunks_cover_the_whole_text(spark, n):
    words = [f"w{i}" for i in range(n)]
    docs = spark.createDataFrame([(1, " ".join(words))], "doc_id long, text string")
    got = [r["words"] for r in text.chunks(docs, size=10, overlap=2).orderBy("chunk").collect()]
    joined = got[0] + [w for c in got[1:] for w in c[2:]]
    assert joined == words and all(len(c) <= 10 for c in got)


def test_words_and_space(spark):
    df = spark.createDataFrame([("  Carência: 30\n dias—ÚTEIS ",)], "t string")
    assert df.select(text.words(F.col("t"))).first()[0] == ["carência", "30", "dias", "úteis"]
    assert df.select(text.normal_space(F.col("t"))).first()[0] == "Carência: 30 dias—ÚTEIS"


@pytest.mark.parametrize("battery", [500, 2])
def test_term_topk_matches_brute_force(spark, monkeypatch, battery):
    monkeypatch.setattr(retrieval, "BATTERY", battery)
    monkeypatch.setattr(retrieval, "CELLS_AT_ONCE", 100)
    rng = random.Random(5)
    vocab = [f"t{i}" for i in range(30)]
    docs = [(i, " ".join(rng.choice(vocab[: 1 + rng.randrange(30)]) for _ in range(rng.randrange(1, 60)))) for i in range(60)]
    asked = [(i, " ".join(rng.sample(vocab, 5))) for i in range(5)]
    chunked = text.chunks(spark.createDataFrame(docs, "doc_id long, text string").repartition(3), size=20, overlap=5)
    got = {(r["item_id"], r["rank"]): (r["doc_id"], r["chunk"], r["score"]) for r in retrieval.term_topk(
        chunked, spark.createDataFrame(asked, "item_id long, text string"), 3).collect()}
    chunks = [(r["doc_id"], r["chunk"], set(r["words"])) for r in chunked.collect()]
    want = {}
    for q, t in asked:
        scored = []
        for d, c, w in chunks:
            shared = set(t.split()) & w
            s = sum(int(np.floor(1000 * np.log(len(chunks) / sum(x in y[2] for y in chunks)))) for x in shared)
            if s > 0:
                scored.append((-s, d, c))
        for i, (s, d, c) in enumerate(sorted(scored)[:3]):
            want[(q, i + 1)] = (d, c, -s)
    assert got == want


def test_vector_topk_keeps_negative_neighbours(spark):
    rows = [(1, [1.0, 0.0]), (2, [-1.0, 0.1]), (3, [0.9, 0.1]), (4, [-1.0, -1.0])]
    v = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(3)
    got = [(r["rank"], r["vec_id"]) for r in retrieval.vector_topk(v, v.filter("vec_id = 1"), 4).orderBy("rank").collect()]
    assert got == [(1, 1), (2, 3), (3, 4), (4, 2)]


def test_answer_checks(spark):
    answers = spark.createDataFrame(
        [("before", 1, "once every 6 months"), ("after", 1, "once every 12 months"), ("after", 2, None)],
        "run string, item_id long, answer string")
    expected = spark.createDataFrame(
        [(1, "required", "12 months"), (1, "forbidden", r"\b6 months"), (2, "required", "x")],
        "item_id long, kind string, pattern string")
    checked = retrieval.check_answers(answers, expected)
    assert {(r["run"], r["item_id"]): r["passed"] for r in checked.collect()} == {
        ("before", 1): False, ("after", 1): True, ("after", 2): False}
    rates = {r["run"]: r["pass_rate"] for r in retrieval.pass_rates(checked).collect()}
    assert rates == {"before": 0.0, "after": 0.5}


def test_dated_rule_holds_until_its_successor(spark):
    ceilings = spark.createDataFrame(
        [("88", dt.date(2026, 3, 1), 2500.0), ("88", dt.date(2026, 9, 1), 3000.0)],
        "code string, valid_from date, ceiling double")
    rows = spark.createDataFrame(
        [(1, "88", dt.date(2026, 8, 31)), (2, "88", dt.date(2026, 9, 1)), (3, "88", dt.date(2026, 2, 1)),
         (4, "99", dt.date(2026, 9, 1))], "id long, code string, day date")
    got = {r["id"]: r["ceiling"] for r in rules.effective(rows, ceilings, "code", "day", "ceiling", "id").collect()}
    assert got == {1: 2500.0, 2: 3000.0, 3: None, 4: None}
    spans = rules.validity(ceilings, "code").orderBy("valid_from").collect()
    assert [r["valid_to"] for r in spans] == [dt.date(2026, 9, 1), None]


def test_response_shapes(spark):
    rows = [
        ('{"output": [{"content": [{"type": "reasoning", "text": "x"}, {"type": "text", "text": "a"}]}, {"type": "call"}, {"content": [{"type": "output_text", "text": "b"}]}]}', "a\nb"),
        ('{"choices": [{"message": {"content": "c"}}, {"message": {"content": "d"}}]}', "c"),
        ('{"messages": [{"content": "e"}, {"content": "f"}]}', "f"),
        ('{"output": [], "choices": [{"message": {"content": "g"}}]}', "g"),
        ('{"error": "no"}', '{"error": "no"}')]
    df = spark.createDataFrame(rows, "r string, want string")
    for r in df.select(payload.response_text(F.col("r")).alias("got"), "want").collect():
        assert r["got"] == r["want"]
    scored = spark.createDataFrame([('{"predictions": [0.25]}',), ("broken",)], "r string")
    assert [r[0] for r in scored.select(payload.first_prediction(F.col("r"))).collect()] == [0.25, None]


@pytest.mark.parametrize("hot", [2_000_000, 3])
def test_dated_rules_match_brute_force(spark, monkeypatch, hot):
    from claimrisk.operators import joins
    monkeypatch.setattr(joins, "HOT_ROWS", hot)
    rng = random.Random(8)
    day = dt.date(2020, 1, 1)
    ceilings = [(rng.choice("abc"), day + dt.timedelta(rng.randrange(900)), rng.choice([None, 1.0, 2.0, 3.0, 4.0]))
                for _ in range(60)] + [(None, day, 9.0), ("a", None, 9.0)]
    rows = [(i, rng.choice(["a", "a", "a", "b", "c", "d", None]),
             rng.choice([None, *[day + dt.timedelta(rng.randrange(-50, 1000))] * 9])) for i in range(300)]
    got = {r.id: r.ceiling for r in rules.effective(
        spark.createDataFrame(rows, "id long, code string, day date").repartition(3),
        spark.createDataFrame(ceilings, "code string, valid_from date, ceiling double"),
        "code", "day", "ceiling", "id").collect()}
    assert len(got) == len(rows)
    for i, code, at in rows:
        held = [(f, v is not None, v or 0, v) for c, f, v in ceilings
                if c == code and c is not None and f is not None and at is not None and f <= at]
        assert got[i] == (max(held)[-1] if held else None), (i, code, at)


def test_no_revisions_are_gathered(spark):
    rows = spark.createDataFrame([(1, "a", dt.date(2020, 1, 1))], "id long, code string, day date")
    revisions = spark.createDataFrame([("a", dt.date(2019, 1, 1), 1.0)], "code string, valid_from date, ceiling double")
    plan = rules.effective(rows, revisions, "code", "day", "ceiling", "id")._jdf.queryExecution().toString()
    assert "collect_list" not in plan


def test_common_terms_are_pruned_without_changing_the_scores():
    import pandas as pd
    rng = np.random.default_rng(3)
    weights = {f"t{i}": int(4000 / (i + 1)) + 1 for i in range(60)}  # t59 is the most common
    local = pd.DataFrame([(q, t, weights[t]) for q in range(40) for t in rng.choice(list(weights), 9, replace=False)],
                         columns=["question", "term", "weight"])
    battery = retrieval.Battery(local)
    place = {t: i for i, t in enumerate(battery.terms)}
    least, best, pairs = np.zeros(40), {q: [] for q in range(40)}, 0
    everything = {q: [] for q in range(40)}
    for batch in range(12):
        chunks = [[t for i, t in enumerate(weights) if rng.random() < (i + 1) / 90] for _ in range(100)]
        row = np.repeat(np.arange(100), [len(c) for c in chunks])
        term = np.array([place.get(t, -1) for c in chunks for t in c])
        at, question, score = battery.scored(row[term >= 0], term[term >= 0], 100, least)
        for r, q, x in zip(at.tolist(), question.tolist(), score.tolist()):
            best[q].append((-x, batch * 100 + r))
        own = {q: set(local.term[local.question == q]) for q in range(40)}
        for q in range(40):
            everything[q] += [(-sum(weights[t] for t in own[q] & set(c)), batch * 100 + r) for r, c in enumerate(chunks)
                              if own[q] & set(c)]
            best[q] = sorted(best[q])[:3]
            least[q] = -best[q][-1][0] if len(best[q]) == 3 else 0
    assert best == {q: sorted(x)[:3] for q, x in everything.items()}
    assert battery.pairs < 40 * 1200 / 3
