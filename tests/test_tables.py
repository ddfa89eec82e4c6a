"""Sources, sinks and session helpers."""

import datetime as dt
import random

import pytest

from claimrisk import session
from claimrisk.operators.arrays import add_to_array
from claimrisk.plans import features
from claimrisk.schemas import CONTRACT_NAMES, FEATURES, TABLES
from claimrisk.sources import domain, tables


def test_declared_schemas_match_the_files(spark, root):
    for name in TABLES:
        declared = tables.read_table(spark, root, name)
        found = spark.read.parquet(f"{root}/{name}.parquet")
        assert [(f.name, f.dataType) for f in declared.schema] == [(f.name, f.dataType) for f in found.schema], name


def test_overwrite_append_and_replace(spark):
    tables.overwrite_table(spark.range(3).withColumnRenamed("id", "a"), "t_sink")
    tables.overwrite_table(spark.createDataFrame([(1, "x")], "a long, b string"), "t_sink")
    tables.append_table(spark.createDataFrame([("y", 2)], "b string, a long"), "t_sink")
    assert sorted(tuple(r) for r in spark.table("t_sink").collect()) == [(1, "x"), (2, "y")]
    tables.create_or_replace_as(spark, "t_ctas", "SELECT count(*) AS n FROM t_sink")
    assert tables.preview(spark.table("t_ctas"))[0]["n"] == 2
    assert tables.tables_like(spark, "t_s%").count() == 1


def test_csv_has_a_header(spark, tmp_path):
    path = str(tmp_path / "out")
    tables.write_csv(spark.createDataFrame([(1, "x")], "a long, b string"), path)
    back = spark.read.option("header", True).csv(path)
    assert back.columns == ["a", "b"] and back.count() == 1


def test_files_and_listing(spark, tmp_path):
    (tmp_path / "a.txt").write_bytes(b"hello")
    (tmp_path / "b.bin").write_bytes(b"x" * 9)
    listed = {r["name"]: r["size"] for r in tables.directory_listing(spark, str(tmp_path)).collect()}
    assert listed == {"a.txt": 5, "b.bin": 9}
    only = tables.binary_files(spark, str(tmp_path), "*.txt").collect()
    assert len(only) == 1 and bytes(only[0]["content"]) == b"hello"


def test_every_byte_of_a_file_is_read_in_splits(spark, tmp_path):
    rng = random.Random(4)
    contents = {"empty": b"", "line": b"a\nb\n", "zero": b"a\n\0\0", "plain": "PAR1\ufeff\r\n\0é".encode() + b"\xff",
                "only": b"\n", "large": rng.randbytes(70_000)}
    for name, content in contents.items():
        (tmp_path / name).write_bytes(content)
    asked = {"spark.sql.files.maxPartitionBytes": "20000", "spark.sql.files.openCostInBytes": "0"}
    before = {k: spark.conf.get(k) for k in asked}
    try:
        for k, v in asked.items():
            spark.conf.set(k, v)
        pieces = tables.binary_files(spark, str(tmp_path), "large", "\n")
        assert pieces.rdd.getNumPartitions() >= 4
        assert b"\n".join(bytes(r["content"]) for r in pieces.collect()) == contents["large"].removesuffix(b"\n")
        read = {r["name"]: r["read"] for r in tables.bytes_read(spark, str(tmp_path)).collect()}
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert read == {name: len(content) for name, content in contents.items() if content}


def test_database_and_constant_row(spark):
    tables.create_database(spark, "scratch_db")
    tables.overwrite_table(spark.range(1), "scratch_db.t")
    assert spark.catalog.currentDatabase() == "scratch_db"
    tables.drop_database(spark, "scratch_db")
    assert spark.catalog.currentDatabase() == "default"
    assert tables.one_row(spark, n="1 + 1", s="upper('a')").first()[:] == (2, "A")
    name = tables.user_schema_name("'Ana.Maria-Lima@example.org'")
    assert tables.one_row(spark, s=name).first()["s"] == "ana_maria_lima"


def test_functions_like(spark):
    spark.sql("CREATE OR REPLACE TEMPORARY FUNCTION seek_one(x INT) RETURNS TABLE(y INT) RETURN SELECT x")
    assert any("seek_one" in r[0] for r in tables.functions_like(spark, "*seek*").collect())


def test_add_to_array_is_idempotent(spark):
    df = spark.createDataFrame([(1, ["a"]), (2, ["p"]), (3, [])], "k long, plans array<string>")
    got = {r["k"]: r["plans"] for r in add_to_array(df, spark.range(1, 3).withColumnRenamed("id", "k"), "k", "plans", "p").collect()}
    assert got == {1: ["a", "p"], 2: ["p"], 3: []}


def test_local_rows_have_the_declared_schema(spark):
    rows = tables.local_rows(spark, [(1, "Basic", "pme", 30.0, 0.5)], "plans")
    assert [t for _, t in rows.dtypes] == ["bigint", "string", "string", "double", "double"]


def test_catalog_tables_under_their_source_names(spark):
    """A user's own five tables run through the same feature plan and keep the contract names."""
    d = dt.date(2025, 3, 1)
    frames = {
        "silver_planos": ([(1, "P", "pf", 10.0, 0.7)], "plano_id long, nome_plano string, segmento string, mensalidade double, percentual_reembolso double"),
        "silver_beneficiarios": ([(5, "SP", 1, d)], "beneficiario_id long, uf string, plano_id long, data_adesao date"),
        "silver_prestadores": ([(9, "RJ", False)], "prestador_id long, uf string, credenciado boolean"),
        "silver_procedimentos_rede": ([(1, 5, 9, "81000600", "11", d, 200.0)], "procedimento_id long, beneficiario_id long, prestador_id long, codigo_tuss string, dente string, data_realizacao date, valor_procedimento double"),
        "silver_pedidos_reembolso": ([(1, 5, 9, "81000600", "11", d + dt.timedelta(days=3), d + dt.timedelta(days=5), 1450.0, "NF1", 1)], "pedido_id long, beneficiario_id long, prestador_id long, codigo_tuss string, dente string, data_procedimento date, data_solicitacao date, valor_solicitado double, hash_documento string, fraude_confirmada long"),
    }
    tables.create_database(spark, "lab", use=False)
    for name, (rows, ddl) in frames.items():
        tables.overwrite_table(spark.createDataFrame(rows, ddl), f"lab.{name}")
    row = features.feature_table(spark, domain.catalog_domain(spark, "lab")).first()
    assert [row[f] for f in FEATURES] == [
        1450.0, 7.25, 3, 1, 1, 1, 1, 2, 1, 1, 1450.0, 1.0, 1, 1450.0, 1, 1, 0, 1, 1, 0.7]
    renamed = features.feature_table(
        spark, domain.catalog_domain(spark, "lab")).withColumnsRenamed(CONTRACT_NAMES)
    assert "razao_valor_ref" in renamed.columns and "prest_pct_prox_teto" in renamed.columns
    tables.drop_database(spark, "lab")


class _Conf(dict):
    def set(self, k, v):
        self[k] = v


class _Session:
    def __init__(self, master, **conf):
        self.conf = _Conf(conf)
        self.sparkContext = type("C", (), {"master": master})


def test_work_dir_uses_the_folder_the_session_names():
    assert session.work_dir(_Session("spark://x", **{"spark.checkpoint.dir": "file:///shared/cp"}), "t").startswith("file:///shared/cp/t-")
    with pytest.raises(RuntimeError):
        session.work_dir(_Session("spark://x"), "t")
    local = _Session("local[2]")
    first = session.work_dir(local, "t")
    assert first.rsplit("/", 1)[0] == local.conf["spark.checkpoint.dir"]


def test_intermediate_tables_go_and_kept_ones_stay(spark):
    import os

    from claimrisk.session import intermediate, written

    def folder(df):
        return df.inputFiles()[0].removeprefix("file:").removeprefix("//").rsplit("/", 1)[0]

    with intermediate(spark) as outer:
        with intermediate(spark) as inner:
            gone = written(spark, spark.range(5), "gone")
            passed = inner.keep(written(spark, gone.where("id > 2"), "passed"))
            lost = folder(gone)
        assert not os.path.exists(lost) and passed.count() == 2
        result = outer.keep(written(spark, passed.selectExpr("id * 2 AS id"), "result"))
        between = folder(passed)
    assert not os.path.exists(between) and sorted(r.id for r in result.collect()) == [6, 8]
    alone = written(spark, spark.range(1), "alone")  # outside of a block tables stay
    assert os.path.exists(folder(alone))
    try:
        with intermediate(spark):
            broken = folder(written(spark, spark.range(1), "broken"))
            raise KeyError
    except KeyError:
        assert not os.path.exists(broken)
