import calendar
import datetime as dt
import os
import shutil

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from indistar.sources import catalog as cat
from indistar.sources import readers as rd
from indistar.sources import snapshots as sn
from tests.conftest import RAW


def test_newest_snapshot(spark, tmp_path):
    names = ["bacen_selic_meta_432_20240101_000000.json", "bacen_selic_meta_432_20240301_000000.json",
             "bacen_cdi_12_20240101_000000.json"]
    for i, n in enumerate(names):
        shutil.copy(os.path.join(RAW, n), tmp_path / n)
        os.utime(tmp_path / n, (1_700_000_000 + i, 1_700_000_000 + i))
    got = sn.newest_snapshots(spark, str(tmp_path), {"selic_meta": 432, "cdi": 12})
    assert got["selic_meta"].endswith("20240301_000000.json")
    with pytest.raises(FileNotFoundError):
        sn.newest_snapshots(spark, str(tmp_path), {"dolar_venda": 1})


def test_select_datasets():
    assert list(sn.select_datasets(cat.SERIES, "cdi")) == ["cdi"]
    assert len(sn.select_datasets(cat.SERIES)) == 4
    with pytest.raises(ValueError):
        sn.select_datasets(cat.SERIES, ["nope"])


def test_window_table_leap_start(spark):
    b = spark.createDataFrame([(dt.date(2016, 2, 29), dt.date(2024, 12, 31))], "inicio date, fim date")
    w = [(r.janela_inicio, r.janela_fim) for r in cat.window_table(b).orderBy("janela").collect()]
    assert w == [(dt.date(2016, 2, 29), dt.date(2019, 2, 27)), (dt.date(2019, 2, 28), dt.date(2022, 2, 27)),
                 (dt.date(2022, 2, 28), dt.date(2024, 12, 31))]
    b2 = spark.createDataFrame([(dt.date(2020, 1, 1), dt.date(2022, 12, 31))], "inicio date, fim date")
    assert cat.window_table(b2).count() == 1


def test_window_table_tiles_range(spark):
    b = spark.createDataFrame([(dt.date(2001, 5, 17), dt.date(2025, 3, 2))], "inicio date, fim date")
    w = sorted((r.janela_inicio, r.janela_fim) for r in cat.window_table(b, years=2).collect())
    assert w[0][0] == dt.date(2001, 5, 17) and w[-1][1] == dt.date(2025, 3, 2)
    for (s0, e0), (s1, _) in zip(w, w[1:]):
        assert s1 - e0 == dt.timedelta(days=1)


def test_date_range(spark):
    df = spark.createDataFrame([(dt.date(2020, 1, d),) for d in range(1, 11)], "d date")
    assert cat.date_range(df, "d", dt.date(2020, 1, 3), dt.date(2020, 1, 5)).count() == 3
    with pytest.raises(ValueError):
        cat.date_range(df, "d", dt.date(2020, 2, 1), dt.date(2020, 1, 1))


def test_dim_and_catalogs(spark):
    d = cat.state_dimension(spark)
    assert d.count() == 27 and d.select("uf_sigla").distinct().count() == 27
    assert cat.series_catalog(spark).count() == 4 and cat.indicator_catalog(spark).count() == 5


def test_csv_bom_and_strings(spark, tmp_path):
    p = tmp_path / "dim.csv"
    p.write_bytes("﻿uf_id,uf_sigla,uf_nome,regiao\n11,RO,Rondônia,Norte\n12,AC,\"Acre\",Norte\n".encode("utf-8"))
    df = rd.read_csv_typed(spark, str(p), T.StructType.fromDDL("uf_id int, uf_sigla string, uf_nome string, regiao string"))
    assert df.columns[0] == "uf_id" and df.count() == 2
    s = rd.read_csv_strings(spark, str(p), quoting=False)
    assert s.columns[0] == "uf_id" and s.filter(F.col("uf_nome") == '"Acre"').count() == 1


def test_read_with_file_name(spark):
    df = rd.read_with_file_name(spark, os.path.join(RAW, "bacen_*.json"), "json", multiLine=True)
    assert df.select("arquivo").distinct().count() == 3


def test_scale_conf():
    from indistar.session import scale_conf
    c = scale_conf(100 * 1024 ** 4, 8000)
    assert c["spark.sql.files.maxPartitionBytes"] == "256m"
    assert int(c["spark.sql.shuffle.partitions"]) == 409600
    assert int(scale_conf(10, 8)["spark.sql.shuffle.partitions"]) == 16


def _anniversary(d, n):
    y = d.year + n
    if (d.month, d.day) == (2, 29) and not calendar.isleap(y):
        return dt.date(y, 2, 28)
    return d.replace(year=y)


def test_window_table_matches_anniversary_chain(spark):
    starts = [dt.date(y, 2, 29) for y in range(1904, 2101, 4) if calendar.isleap(y)]
    starts += [dt.date(2015, 2, 28), dt.date(2016, 2, 28), dt.date(2016, 3, 1), dt.date(2019, 12, 31),
               dt.date(2020, 1, 31)]
    rows, want = [], set()
    for idx, s in enumerate(starts):
        e = s + dt.timedelta(days=7000 + 37 * idx)
        rows.append((idx, s, e))
        for n in range(1, 6):
            cur = s
            while cur <= e:
                nxt = _anniversary(cur, n)
                want.add((idx, n, cur, min(nxt - dt.timedelta(days=1), e)))
                cur = nxt
    b = spark.createDataFrame(rows, "k int, inicio date, fim date")
    got = set()
    for n in range(1, 6):
        got |= {(r.k, n, r.janela_inicio, r.janela_fim)
                for r in cat.window_table(b, years=n, keys=["k"]).collect()}
    assert got == want


def test_file_name_filter_prunes_unselected_snapshots(spark, tmp_path):
    """A corrupt file of another dataset is never opened by a FAILFAST read
    filtered on the dataset in the file name (metadata file pruning)."""
    shutil.copy(os.path.join(RAW, "bacen_cdi_12_20240101_000000.json"), tmp_path)
    (tmp_path / "bacen_selic_meta_432_20240101_000000.json").write_text('[{"serie": broken')
    raw = rd.read_flat_series(spark, str(tmp_path), mode="FAILFAST", recursive=True)
    cdi = raw.filter(F.regexp_extract("arquivo", sn.SNAPSHOT_NAME, 2) == "cdi")
    assert cdi.count() > 0
    with pytest.raises(Exception):
        raw.count()
