import datetime as dt
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from indistar.operators import contracts as ct
from indistar.operators import publish as pb
from indistar.sources import readers as rd
from tests.conftest import FIXTURES

C = ct.Contract(
    "t", T.StructType([T.StructField("id", T.IntegerType()), T.StructField("d", T.DateType()),
                       T.StructField("ano", T.IntegerType()), T.StructField("mes", T.IntegerType()),
                       T.StructField("uf", T.IntegerType()), T.StructField("s", T.StringType()),
                       T.StructField("v", T.DecimalType(5, 2))]),
    key=["id"], not_null=["id", "d"], foreign_keys=[(["uf"], "dim", ["uf_id"])],
    year_of_date=("ano", "d"), ranges={"mes": (1, 12)}, fixed={"s": "ok"}, max_length={"s": 2})


def _facts(spark):
    rows = [(1, dt.date(2020, 1, 1), 2020, 1, 11, "ok", 1.0),
            (1, dt.date(2020, 2, 1), 2021, 13, 99, "bad", 12345.0),
            (2, None, 2020, 2, None, "ok", None)]
    return spark.createDataFrame(rows, "id int, d date, ano int, mes int, uf int, s string, v double")


def test_violations_each_rule(spark):
    dim = spark.createDataFrame([(11,)], "uf_id int")
    v = {(r.regra, r.coluna): r.violacoes for r in ct.violations(C, _facts(spark), {"dim": dim}).collect()}
    assert v[("not_null", "d")] == 1 and v[("not_null", "id")] == 0
    assert v[("ano_da_data", "ano")] == 1 and v[("faixa", "mes")] == 1
    assert v[("valor_fixo", "s")] == 1 and v[("tamanho", "s")] == 1
    assert v[("precisao", "v")] == 1 and v[("chave_primaria", "id")] == 1
    assert v[("chave_estrangeira", "uf->dim")] == 1
    with pytest.raises(ValueError):
        ct.assert_contract(C, _facts(spark), {"dim": dim})


def test_typed_by_contract_counts_failed_casts(spark):
    raw = spark.createDataFrame([("1", "2020-01-01", "x"), ("2", "bad", "3")], "id string, d string, n string")
    c = ct.Contract("r", T.StructType([T.StructField("id", T.IntegerType()), T.StructField("d", T.DateType()),
                                       T.StructField("n", T.IntegerType())]), key=["id"])
    typed, fails = ct.typed_by_contract(c, raw)
    f = fails.first()
    assert (f.id, f.d, f.n) == (0, 1, 1)
    assert typed.filter(F.col("d").isNull()).count() == 1


def test_document_problems(spark):
    bad = os.path.join(FIXTURES, "bad")
    files = sorted(os.listdir(bad))
    raw = rd.read_flat_series(spark, os.path.join(bad, "*.json"))
    p = {r.arquivo: r for r in ct.document_problems(raw, files).collect()}
    assert p["bacen_cdi_12_20240102_000000.json"].corrompidos == 1     # malformed
    assert p["bacen_cdi_12_20240103_000000.json"].linhas == 0          # empty array
    assert p["bacen_cdi_12_20240104_000000.json"].corrompidos == 0
    with pytest.raises(Exception):
        rd.read_flat_series(spark, os.path.join(bad, "*.json"), mode="FAILFAST").collect()


def test_upsert_idempotent_and_pointer(spark, tmp_path):
    root = str(tmp_path / "tabela")
    base = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    pb.upsert(spark, base, root, ["k"])
    upd = spark.createDataFrame([(2, "B"), (3, "c")], "k int, v string")
    v1 = pb.upsert(spark, upd, root, ["k"])
    first = sorted(tuple(r) for r in pb.read_current(spark, root).collect())
    v2 = pb.upsert(spark, upd, root, ["k"])
    second = sorted(tuple(r) for r in pb.read_current(spark, root).collect())
    assert first == second == [(1, "a"), (2, "B"), (3, "c")]
    assert v1 != v2 and pb.current_version(spark, root) == v2
    dup = spark.createDataFrame([(5, "x"), (5, "y")], "k int, v string")
    with pytest.raises(ValueError):
        pb.upsert(spark, dup, root, ["k"])


def test_full_refresh_checks_everything_first(spark, tmp_path):
    good = spark.createDataFrame([(1, dt.date(2020, 1, 1), 2020, 1, 11, "ok", 1.0)],
                                 "id int, d date, ano int, mes int, uf int, s string, v double")
    root = str(tmp_path / "wh")
    with pytest.raises(ValueError):
        pb.full_refresh(spark, {"a": (good, C), "b": (_facts(spark), C)}, root,
                        dims={"dim": spark.createDataFrame([(11,)], "uf_id int")})
    assert pb.current_version(spark, root + "/a") is None
    out = pb.full_refresh(spark, {"a": (good, C)}, root, dims={"dim": spark.createDataFrame([(11,)], "uf_id int")})
    counts = {r.tabela: r.linhas for r in pb.post_load_counts(spark, {"a": root + "/a"}).collect()}
    assert counts == {"a": 1} and out == {"a": 1}


def test_publish_csv_and_per_series(spark, tmp_path):
    df = spark.createDataFrame([("cdi", 1), ("cdi", 2), ("selic", 3)], "serie string, v int")
    with pytest.raises(ValueError):
        pb.publish(df, str(tmp_path / "x"), key=["serie"])
    pb.publish(df, str(tmp_path / "ok"), key=["serie", "v"], fmt="csv")
    back = rd.read_csv_typed(spark, str(tmp_path / "ok"), T.StructType.fromDDL("serie string, v int"))
    assert back.count() == 3
    pb.write_per_series(df, str(tmp_path / "per"), "serie", fmt="parquet")
    assert {"serie=cdi", "serie=selic"} <= set(os.listdir(tmp_path / "per"))
    out = pb.land_raw(df, str(tmp_path / "raw"), ["serie"], ["v"], stamp="20240101_000000")
    assert spark.read.json(out).count() == 2
    raw = spark.createDataFrame([("cdi", 12, "01/02/2024", "1,5"), ("cdi", 12, "01/02/2024", "1,7"),
                                 ("cdi", 12, "02/02/2024", "2,0")], "serie string, codigo int, data string, valor string")
    landed = pb.land_raw(raw, str(tmp_path / "raw2"), ["codigo", "data"], ["valor"], stamp="20240102_000000")
    back = rd.read_flat_series(spark, landed, multi_line=False)
    assert sorted((r.data, r.valor) for r in back.collect()) == [("01/02/2024", "1,7"), ("02/02/2024", "2,0")]


def test_upsert_partitions_rewrites_only_touched(spark, tmp_path):
    path = str(tmp_path / "part")
    base = spark.createDataFrame([(1, 2020, "a"), (2, 2021, "b"), (3, 2021, "c")], "k int, ano int, v string")
    assert pb.upsert_partitions(spark, base, path, ["k"], ["ano"]) == 1
    before = {r.valores: r.pasta for r in pb.partitions(spark, path).collect()}
    upd = spark.createDataFrame([(2, 2021, "B"), (4, 2021, "d")], "k int, ano int, v string")
    assert pb.upsert_partitions(spark, upd, path, ["k"], ["ano"]) == 2
    assert pb.upsert_partitions(spark, upd, path, ["k"], ["ano"]) == 3  # replay: same table
    got = sorted(tuple(r) for r in pb.read_current(spark, path).select("k", "ano", "v").collect())
    assert got == [(1, 2020, "a"), (2, 2021, "B"), (3, 2021, "c"), (4, 2021, "d")]
    after = {r.valores: (r.pasta, r.gravado) for r in pb.partitions(spark, path).collect()}
    assert after['{"ano":2020}'] == (before['{"ano":2020}'], 1) and after['{"ano":2021}'][1] == 3
    with pytest.raises(ValueError):
        pb.upsert(spark, upd, path, ["k"])  # partitioned otherwise


def test_failed_commit_read_keeps_the_table(spark, tmp_path, monkeypatch):
    from pyspark.errors import AnalysisException
    root = str(tmp_path / "t")
    pb.upsert(spark, spark.range(100).withColumnRenamed("id", "k"), root, ["k"])

    def broken(*_):
        raise AnalysisException("store is away")
    with monkeypatch.context() as m:
        m.setattr(pb.cm, "manifest", broken)
        with pytest.raises(AnalysisException):
            pb.upsert(spark, spark.range(100, 101).withColumnRenamed("id", "k"), root, ["k"])
    assert pb.read_current(spark, root).count() == 100
    pb.upsert(spark, spark.range(100, 101).withColumnRenamed("id", "k"), root, ["k"])
    assert pb.read_current(spark, root).count() == 101


def test_crash_before_the_commit_keeps_the_table(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "t")
    pb.upsert(spark, spark.range(5).withColumnRenamed("id", "k"), root, ["k"])
    with monkeypatch.context() as m:
        m.setattr(pb.cm, "claim_commit", lambda *a: (_ for _ in ()).throw(RuntimeError("crash")))
        with pytest.raises(RuntimeError):
            pb.upsert(spark, spark.range(5, 9).withColumnRenamed("id", "k"), root, ["k"])
    assert pb.read_current(spark, root).count() == 5


def test_upsert_of_many_partitions(spark, tmp_path):
    from pyspark.sql import functions as F
    path = str(tmp_path / "t")
    days = spark.range(400).select("id", (F.col("id") % 200).alias("a"), F.when(F.col("id") >= 200, F.col("id")).alias("b"))
    pb.upsert_partitions(spark, days.withColumn("v", F.lit(1)), path, ["id"], ["a", "b"])
    pb.upsert_partitions(spark, days.withColumn("v", F.lit(2)), path, ["id"], ["a", "b"])
    got = pb.read_current(spark, path)
    assert got.count() == 400 and got.agg(F.min("v")).first()[0] == 2
    with pytest.raises(ValueError):
        pb.upsert_partitions(spark, days.union(days).withColumn("v", F.lit(3)), path, ["id"], ["a", "b"])


KV = "k long, ano int, v string"


def test_two_writers_lose_nothing(spark, tmp_path):
    """Changes from one base: other partitions are taken over, the same one is
    refused and merged again."""
    root = str(tmp_path)
    frame = lambda *rows: spark.createDataFrame(rows, KV)
    pb.upsert(spark, frame((1, 2020, "a"), (2, 2021, "a"), (3, 2022, "a")), root + "/t", ["k"], ["ano"])
    one, two, three = (pb.cm.Changes(spark, root) for _ in range(3))
    one.upsert("t", frame((4, 2020, "one")), ["k"], ["ano"])
    two.upsert("t", frame((5, 2021, "two")), ["k"], ["ano"])
    three.upsert("t", frame((6, 2021, "three")), ["k"], ["ano"])
    assert (one.commit(), two.commit()) == (2, 3)
    with pytest.raises(pb.cm.CommitConflict):
        three.commit()
    assert pb.upsert(spark, frame((6, 2021, "three")), root + "/t", ["k"], ["ano"]) == 4
    assert sorted(r.k for r in pb.read_current(spark, root + "/t").collect()) == [1, 2, 3, 4, 5, 6]
    assert {r.gravado for r in pb.partitions(spark, root + "/t").collect()} == {1, 2, 4}
    assert sorted(r.k for r in pb.read_current(spark, root + "/t", 1).collect()) == [1, 2, 3]  # an earlier commit


def test_upsert_merges_again_after_another_writer(spark, tmp_path, monkeypatch):
    root, claims = str(tmp_path) + "/t", []
    pb.upsert(spark, spark.createDataFrame([(1, 1, "a")], KV), root, ["k"])
    claim = pb.cm.claim_commit

    def raced(*args):
        if not claims:  # someone else commits first
            claims.append(1)
            pb.upsert(spark, spark.createDataFrame([(2, 1, "b")], KV), root, ["k"])
        return claim(*args)
    monkeypatch.setattr(pb.cm, "claim_commit", raced)
    assert pb.upsert(spark, spark.createDataFrame([(3, 1, "c")], KV), root, ["k"]) == 3
    assert sorted(r.k for r in pb.read_current(spark, root).collect()) == [1, 2, 3]


def test_crash_between_two_tables_leaves_both_old(spark, tmp_path, monkeypatch):
    root, old = str(tmp_path), spark.createDataFrame([(1, 1, "old")], KV)
    new = spark.createDataFrame([(1, 1, "new")], KV)
    pb.full_refresh(spark, {"a": (old, None), "b": (old, None)}, root)
    write = pb.cm.Changes._write

    def crash(self, name, *rest):
        if name == "b":
            raise RuntimeError("crash")
        write(self, name, *rest)
    with monkeypatch.context() as m:
        m.setattr(pb.cm.Changes, "_write", crash)
        with pytest.raises(RuntimeError):
            pb.full_refresh(spark, {"a": (new, None), "b": (new, None)}, root)
    assert [pb.read_current(spark, f"{root}/{n}").first().v for n in "ab"] == ["old", "old"]
    pb.full_refresh(spark, {"a": (new, None), "b": (new, None)}, root)
    assert [pb.read_current(spark, f"{root}/{n}").first().v for n in "ab"] == ["new", "new"]
    pb.publish(spark.createDataFrame([], KV), root + "/a", key=["k"])
    assert pb.read_current(spark, root + "/a").count() == 0 and pb.current_version(spark, root + "/a") == 3
