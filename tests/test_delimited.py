"""Delimited import: header by name, width checked, nothing lost."""

import random

import pytest
from pyspark.sql import functions as F

from indistar.operators import aggregates as agg
from indistar.sources import delimited as dl

COLUMNS = ["a", "b", "c"]


def _land(folder, **files):
    for name, text in files.items():
        (folder / f"{name}.csv").write_bytes(text.encode("utf-8"))
    return str(folder)


def _name(col="arquivo_caminho"):
    return F.regexp_extract(col, r"([^/]+)\.csv$", 1).alias("f")


def _rows(taken):
    return sorted((r.f, r.a, r.b, r.c) for r in taken.rows.select(_name(), *COLUMNS).collect())


def _rejects(taken):
    return sorted(map(tuple, taken.rejects.select(_name(), "motivo", "linha").collect()))


def test_header_decides_and_width_is_checked(spark, tmp_path):
    taken = dl.read_delimited(spark, _land(
        tmp_path, plain="a,b,c\n1,2,3\n4,,\n", swapped="\ufeffc, b ,a\n3,2,1\n", short="a,b,c\n1,2\n1,2,3\n\n",
        long='a,b,c\n1,2,3,4\n"x,y",2\n', lacks="a,b\n1,2\n", more="a,b,c,d\n1,2,3,4\n", twice="a,b,c,c\n1,2,3,4\n",
        crlf="a,b,c\r\n7,8,9\r\n", headed="a,b,c\na,b,c\n", bare="a,b,c", empty=""), COLUMNS)
    assert _rows(taken) == sorted([("plain", "1", "2", "3"), ("plain", "4", None, None), ("swapped", "1", "2", "3"),
                                   ("short", "1", "2", "3"), ("crlf", "7", "8", "9"), ("headed", "a", "b", "c"),
                                   ("long", '"x', 'y"', "2")])  # quoting is off
    assert _rejects(taken) == sorted([("short", "curta", "1,2"), ("short", "curta", ""), ("long", "longa", "1,2,3,4"),
                                      ("lacks", "cabecalho", "1,2"), ("more", "cabecalho", "1,2,3,4"),
                                      ("twice", "cabecalho", "1,2,3,4")])
    files = {r.f: r for r in taken.files.select(_name(), "colunas", "faltam", "sobram", "repetidas").collect()}
    assert files["swapped"].colunas == ["c", "b", "a"] and files["swapped"].faltam == []
    assert (files["lacks"].faltam, files["more"].sobram, files["twice"].repetidas) == (["c"], ["d"], ["c"])
    assert "bare" in files and "empty" not in files


@pytest.mark.parametrize("few", [True, False])
def test_files_cut_into_many_splits(spark, tmp_path, monkeypatch, few):
    """Every line of large and small files is a row or a reject, whichever way
    the splits fall, and each file's header is found."""
    monkeypatch.setattr(dl, "BROADCAST_FILES", 10_000 if few else 0)
    rng, want, refused, files = random.Random(3), [], [], {}
    for f in range(7):
        header = rng.sample(COLUMNS, 3)
        lines = [",".join(header)]
        for i in range(rng.choice([1, 40, 900])):
            width = rng.choice([3, 3, 3, 2, 4])
            values = [f"{f}.{i}.{k}" for k in range(width)]
            lines.append(",".join(values))
            if width == 3:
                row = dict(zip(header, values))
                want.append((f"f{f}", *(row[c] for c in COLUMNS)))
            else:
                refused.append((f"f{f}", "curta" if width == 2 else "longa", lines[-1]))
        files[f"f{f}"] = "\n".join(lines) + "\n"
    path, key = _land(tmp_path, **files), "spark.sql.files.maxPartitionBytes"
    old, cost = spark.conf.get(key), spark.conf.get("spark.sql.files.openCostInBytes")
    try:
        spark.conf.set(key, "700")
        spark.conf.set("spark.sql.files.openCostInBytes", "10")
        taken = dl.read_delimited(spark, path, COLUMNS)
        assert taken.rows.rdd.getNumPartitions() > 10 or not few
        assert _rows(taken) == sorted(want) and _rejects(taken) == sorted(refused)
        # filters and pruned columns leave every plan with the same lines
        assert taken.rows.filter(F.col("arquivo_caminho").endswith("f3.csv")).count() == sum(w[0] == "f3" for w in want)
        assert taken.rows.select("a").count() == len(want)
    finally:
        spark.conf.set(key, old)
        spark.conf.set("spark.sql.files.openCostInBytes", cost)


def test_other_delimiter_and_profile_with_columns(spark, tmp_path):
    path = _land(tmp_path, x="a|b|c\n1|2|3\n1|2|3\n2||\n", y="c|a|b\n", z="a|b\n9|9\n")
    taken = dl.read_delimited(spark, path, COLUMNS, "|")
    profile = agg.with_columns_of_files(agg.file_profile(taken.rows, ["a"], "arquivo_caminho"), taken.files)
    got = {r.f: tuple(r)[1:] for r in profile.select(_name(), "colunas", "faltam", "linhas", "chaves_duplicadas", "celulas_nulas").collect()}
    assert got == {"x": (["a", "b", "c"], [], 3, 1, 2), "y": (["c", "a", "b"], [], 0, 0, 0), "z": (["a", "b"], ["c"], 0, 0, 0)}
    heads = dl.file_headers(spark, path, "|")
    assert {tuple(r.colunas) for r in heads.collect()} == {("a", "b", "c"), ("c", "a", "b"), ("a", "b")}
