"""Queries over documents: elements, cells, chunks, retrieval, dated rules and JSON values."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimrisk.functions import html, text
from claimrisk.operators import retrieval, rules
from claimrisk.operators.ranking import first_per_group
from claimrisk.plans import sqlparts as q
from claimrisk.plans.lake import once, silver
from claimrisk.plans.pagesql import ELEMENTS
from claimrisk.sources.tables import read_table, spread

TOP = 3
NEIGHBOURS = 5


def effective_rule(spark: SparkSession, root: str) -> DataFrame:
    """The ceiling in force on each claim's request date; later rules do not reach back."""
    ceilings = spark.createDataFrame(
        [(c, "1990-01-01", 50000.0) for c in ("ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD")]
        + [("PROMO", "1998-09-01", 60000.0), ("PROMO", "2000-01-01", 65000.0),
           ("ECONOMY", "1999-03-15", 45000.0)],
        "proc_code string, valid_from string, ceiling double",
    ).withColumn("valid_from", F.col("valid_from").cast("date"))
    rows = rules.effective(
        silver(spark, root).claims, ceilings, "proc_code", "req_date", "ceiling", "claim_id")
    return rows.select(
        "claim_id", "ceiling", F.when(F.col("amount") > F.col("ceiling"), 1).otherwise(0).alias("above"))


def variant_elements(spark: SparkSession, root: str) -> DataFrame:
    """Values read from JSON by path."""
    read_table(spark, root, "events").select(
        "event_id", F.parse_json("props").alias("props")).createOrReplaceTempView("event_props")
    return spark.sql("SELECT event_id, props:k::bigint AS k, props:missing::string AS missing FROM event_props")


def variant_array(spark: SparkSession, root: str) -> DataFrame:
    """Documents as nested JSON, opened again element by element."""
    docs = read_table(spark, root, "documents").select(
        "doc_id", F.parse_json(F.to_json(F.struct(F.struct(F.transform(
            F.split("text", "\n"),
            lambda line: F.struct(F.lit("text").alias("type"), line.alias("content")),
        ).alias("elements")).alias("document")))).alias("doc"))
    docs.createOrReplaceTempView("parsed_documents")
    return spark.sql("""
        SELECT doc_id, el:type::string AS type, count(*) AS elements,
               sum(length(el:content::string)) AS characters
        FROM (SELECT doc_id, explode(CAST(doc:document:elements AS ARRAY<VARIANT>)) AS el
              FROM parsed_documents)
        GROUP BY doc_id, type""")


def page_elements(spark: SparkSession, root: str) -> DataFrame:
    return html.element_rows(spread(read_table(spark, root, "pages"), "page_id"))


def element_counts(spark: SparkSession, root: str) -> DataFrame:
    return page_elements(spark, root).groupBy("type").agg(F.count("*").alias("elements"))


def cell_lookup(spark: SparkSession, root: str) -> DataFrame:
    """Cells of a table per supplier, taken from markup by the page splitter: value, row and column.

    A supplier's number spans the two rows of its table, its nation the last two columns of the second.
    """
    def cell(value, tag="td", attributes=""):
        return F.concat(F.lit(f"<{tag}{attributes}>"), value, F.lit(f"</{tag}>"))

    def row(*cells):
        return F.concat(F.lit("<tr>"), *cells, F.lit("</tr>"))

    page = F.concat(
        F.lit("<h2>Supplier</h2><table>"),
        row(*[cell(F.lit(n), "th") for n in ("id", "name", "balance")]),
        row(cell(F.col("s_suppkey").cast("string"), "td", ' rowspan="2"'), cell(F.col("s_name")),
            cell(F.floor("s_acctbal").cast("string"))),
        row(cell(F.concat(F.lit("A &amp; "), F.col("s_nationkey").cast("string")), "td", " colspan=2")),
        F.lit("</table>"))
    pages = read_table(spark, root, "supplier").select(
        F.col("s_suppkey").alias("page_id"), page.alias("html"))
    tables = html.element_rows(pages).filter("type = 'table'")
    return html.table_cells(tables, ["page_id"]).filter("column_label <> 'id'").select(
        "page_id", "row", "row_label", "column_label", "value")


def _chunks(spark, root):
    """The chunk table, written once: counting terms and scoring read it several times."""
    return once(spark, root, "chunks", lambda: text.chunks(
        spread(read_table(spark, root, "documents").select("doc_id", "text"), "doc_id")))


def chunk_topk(spark: SparkSession, root: str) -> DataFrame:
    """The best chunks for every question of the battery, with document and chunk as the source."""
    return retrieval.term_topk(_chunks(spark, root), read_table(spark, root, "benchmark"), TOP)


def vector_topk(spark: SparkSession, root: str) -> DataFrame:
    """Nearest vectors to the first vector of every label."""
    vectors = read_table(spark, root, "embeddings")
    asked = first_per_group(vectors, ["label"], ["vec_id"], 1).select("vec_id", "embedding")
    return retrieval.vector_topk(vectors, asked, NEIGHBOURS).select("question", "rank", "vec_id")


def answer_checks(spark: SparkSession, root: str) -> DataFrame:
    """Pass rate of the retrieved answers, with plain and with weighted terms.

    A good answer holds all words of the question and does not start with a digit.
    """
    questions = read_table(spark, root, "benchmark")
    chunked = _chunks(spark, root)
    runs = [
        retrieval.term_topk(chunked, questions, 1, weighted=w).select(
            F.lit(run).alias("run"), "item_id", "doc_id", "chunk")
        for run, w in (("plain", False), ("weighted", True))]
    answers = runs[0].unionByName(runs[1]).join(chunked, ["doc_id", "chunk"]).select(
        "run", "item_id", F.concat_ws(" ", "words").alias("answer"))
    every = F.array_distinct(text.words(F.col("text")))
    required = questions.select(
        "item_id", F.lit("required").alias("kind"),
        F.explode(F.transform(every, lambda w: F.concat(F.lit("(^| )"), w, F.lit("( |$)")))).alias("pattern"))
    forbidden = questions.select(
        "item_id", F.lit("forbidden").alias("kind"), F.lit("^[0-9]").alias("pattern"))
    return retrieval.pass_rates(
        retrieval.check_answers(answers, required.unionByName(forbidden)))


QUERIES = {
    f.__name__: f for f in (
        effective_rule, variant_elements, variant_array, page_elements, element_counts,
        cell_lookup, chunk_topk, vector_topk, answer_checks)
}

_WORDS = r"""list_filter(string_split(trim(regexp_replace(lower(text), '[^\p{L}\p{N}]+', ' ', 'g')), ' '), lambda w: w <> '')"""
_CHUNKS = f"""
dw AS (SELECT doc_id, {_WORDS} AS w FROM documents),
st AS (SELECT doc_id, w, unnest(range(0, greatest(len(w) - 21, 0) + 1, 80)) AS s FROM dw WHERE len(w) > 0),
ch AS (SELECT doc_id, CAST(s // 80 AS INTEGER) AS chunk, w[s + 1 : s + 100] AS words FROM st),
ct AS (SELECT DISTINCT doc_id, chunk, unnest(words) AS term FROM ch),
qt AS (SELECT DISTINCT item_id, unnest({_WORDS}) AS term FROM benchmark),
wt AS (SELECT term, CAST(floor(1000 * ln((SELECT count(*) FROM ch)::DOUBLE / count(*))) AS BIGINT) AS weight
  FROM ct WHERE term IN (SELECT term FROM qt) GROUP BY term)"""


def _topk(weight: str, k: int) -> str:
    return f"""(SELECT item_id, doc_id, chunk, score, CAST(row_number() OVER (PARTITION BY item_id
    ORDER BY score DESC, doc_id, chunk) AS INTEGER) AS rank FROM (
    SELECT item_id, doc_id, chunk, CAST(sum({weight}) AS BIGINT) AS score
    FROM ct JOIN qt USING (term) JOIN wt USING (term) GROUP BY ALL) WHERE score > 0
  QUALIFY rank <= {k})"""


ORACLE = {
    "effective_rule": f"""WITH {q.CLAIMS},
base AS (SELECT DISTINCT proc_code, DATE '1990-01-01' AS valid_from, 50000.0::DOUBLE AS ceiling FROM claims
  UNION ALL VALUES ('PROMO', DATE '1998-09-01', 60000.0), ('PROMO', DATE '2000-01-01', 65000.0),
                   ('ECONOMY', DATE '1999-03-15', 45000.0)),
r AS (SELECT *, lead(valid_from) OVER (PARTITION BY proc_code ORDER BY valid_from) AS valid_to FROM base)
SELECT claim_id, ceiling, CASE WHEN amount > ceiling THEN 1 ELSE 0 END AS above
FROM claims c LEFT JOIN r ON r.proc_code = c.proc_code AND valid_from <= req_date
  AND (valid_to IS NULL OR req_date < valid_to)""",
    "variant_elements": """SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k,
  json_extract_string(props, '$.missing') AS missing FROM events""",
    "variant_array": """SELECT doc_id, 'text' AS type, count(*) AS elements,
  CAST(sum(length(line)) AS BIGINT) AS characters
FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents) GROUP BY doc_id""",
    "page_elements": f"{ELEMENTS} SELECT page_id, position, type, content FROM elements",
    "element_counts": f"{ELEMENTS} SELECT type, count(*) AS elements FROM elements GROUP BY type",
    "cell_lookup": """WITH c AS (
  SELECT s_suppkey AS page_id, 0::INTEGER AS "row", 'name' AS column_label, s_name AS value FROM supplier
  UNION ALL SELECT s_suppkey, 0::INTEGER, 'balance', CAST(floor(s_acctbal) AS BIGINT)::VARCHAR FROM supplier
  UNION ALL SELECT s_suppkey, 1::INTEGER, l, 'A & ' || s_nationkey FROM supplier, (VALUES ('name'), ('balance')) t(l))
SELECT page_id, "row", page_id::VARCHAR AS row_label, column_label, value FROM c""",
    "chunk_topk": f"WITH {_CHUNKS} SELECT item_id, doc_id, chunk, score, rank FROM {_topk('weight', TOP)}",
    "vector_topk": f"""WITH a AS (SELECT vec_id AS question, embedding::DOUBLE[] AS e FROM embeddings
  QUALIFY row_number() OVER (PARTITION BY label ORDER BY vec_id) = 1),
s AS (SELECT question, vec_id, round(list_cosine_similarity(embedding::DOUBLE[], e), 6) AS score FROM a, embeddings)
SELECT question, CAST(row_number() OVER (PARTITION BY question ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id
FROM s QUALIFY rank <= {NEIGHBOURS}""",
    "answer_checks": f"""WITH {_CHUNKS},
a AS (SELECT 'plain' AS run, item_id, doc_id, chunk FROM {_topk('1', 1)}
  UNION ALL SELECT 'weighted', item_id, doc_id, chunk FROM {_topk('weight', 1)}),
f AS (SELECT item_id, list_distinct(w) AS _, w FROM (SELECT item_id, {_WORDS} AS w FROM benchmark)),
u AS (SELECT DISTINCT item_id, unnest(w) AS term FROM f),
c AS (SELECT a.run, a.item_id, bool_and(list_contains(ch.words, u.term))
    AND NOT bool_or(regexp_matches(array_to_string(ch.words, ' '), '^[0-9]')) AS ok
  FROM a JOIN ch USING (doc_id, chunk) JOIN u ON u.item_id = a.item_id GROUP BY ALL)
SELECT run, count(*) AS questions, count(*) FILTER (ok) AS passed,
  count(*) FILTER (ok) / count(*) AS pass_rate FROM c GROUP BY run""",
}
