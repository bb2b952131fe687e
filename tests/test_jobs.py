import datetime as dt
import os
import shutil

import pytest

from indistar.operators import publish as pb
from indistar.plans import jobs
from tests.conftest import RAW


@pytest.fixture()
def landing(tmp_path):
    d = tmp_path / "raw"
    d.mkdir()
    for i, n in enumerate(sorted(os.listdir(RAW))):
        shutil.copy(os.path.join(RAW, n), d / n)
        os.utime(d / n, (1_700_000_000 + i, 1_700_000_000 + i))
    return d


def test_run_ibge_end_to_end(spark, landing, tmp_path):
    counts = {r.tabela: r.linhas for r in
              jobs.run_ibge(spark, str(landing), str(tmp_path / "work"), str(tmp_path / "wh"),
                            csv_root=str(tmp_path / "csv")).collect()}
    assert counts["dim_uf"] == 27 and counts["populacao_municipio"] == 11
    assert counts["PIB_pessoas"] == 2 and counts["PIB_financeiro"] == 2 and counts["PIB_percentual"] == 2
    assert counts["pib_brasil_ano"] == 6 and counts["faixa_etaria_uf"] == 4
    assert counts["desemprego_uf_trimestre"] == 5 and counts["ipca_area_mes"] == 4
    # rerun: the upsert leaves every table as it was
    again = {r.tabela: r.linhas for r in
             jobs.run_ibge(spark, str(landing), str(tmp_path / "work"), str(tmp_path / "wh")).collect()}
    assert again == counts
    assert os.path.isdir(tmp_path / "csv" / "ipca_area_mes")
    names = ["dim_uf", "populacao_municipio", "PIB_pessoas", "PIB_financeiro", "PIB_percentual",
             "faixa_etaria_uf", "desemprego_uf_trimestre", "ipca_area_mes"]
    loaded = {r.tabela: r.linhas for r in
              jobs.load_csv_tables(spark, str(tmp_path / "csv"), str(tmp_path / "pg"), names).collect()}
    assert loaded == {n: counts[n] for n in names}
    with pytest.raises(Exception):
        jobs.load_csv_tables(spark, str(tmp_path / "csv"), str(tmp_path / "pg"), ["bacen_serie_historica"])


def test_run_ibge_selection_and_unknown(spark, landing, tmp_path):
    counts = {r.tabela: r.linhas for r in
              jobs.run_ibge(spark, str(landing), str(tmp_path / "w"), str(tmp_path / "wh"), datasets=["pib"]).collect()}
    assert set(counts) == {"dim_uf", "PIB_pessoas", "PIB_financeiro", "PIB_percentual", "pib_brasil_ano"}
    with pytest.raises(ValueError):
        jobs.run_ibge(spark, str(landing), str(tmp_path / "w"), str(tmp_path / "wh"), datasets=["nope"])


def test_run_bacen(spark, landing, tmp_path):
    out = str(tmp_path / "wh")
    counts = {r.tabela: r.linhas for r in jobs.run_bacen(spark, str(landing), out, ["selic_meta", "cdi"]).collect()}
    assert counts == {"bacen_serie_historica": 4, "bacen_selic_meta": 3, "bacen_cdi": 1}
    hist = {(r.serie_id, r.data_referencia): float(r.valor)
            for r in pb.read_current(spark, out + "/bacen_serie_historica").collect()}
    assert hist[(432, dt.date(2024, 2, 2))] == 11.5
    newest = {r.tabela: r.linhas for r in
              jobs.run_bacen(spark, str(landing), str(tmp_path / "wh2"), "selic_meta", all_snapshots=False,
                             start=dt.date(2024, 2, 3), end=dt.date(2024, 2, 3)).collect()}
    assert newest == {"bacen_serie_historica": 1, "bacen_selic_meta": 1}


def test_run_ibge_partitioned_fact(spark, landing, tmp_path):
    """The municipal fact published as a year-partitioned folder, upserted
    partition by partition; the other tables keep versions + pointers."""
    parts = {"populacao_municipio": ["ano"]}
    first = {r.tabela: r.linhas for r in
             jobs.run_ibge(spark, str(landing), str(tmp_path / "work"), str(tmp_path / "wh"),
                           csv_root=str(tmp_path / "csv"), partition_by=parts).collect()}
    loaded = {r.tabela: r.linhas for r in
              jobs.load_csv_tables(spark, str(tmp_path / "csv"), str(tmp_path / "pg"),
                                   ["populacao_municipio"]).collect()}
    assert loaded == {"populacao_municipio": 11}   # CSV header in contract order
    again = {r.tabela: r.linhas for r in
             jobs.run_ibge(spark, str(landing), str(tmp_path / "work"), str(tmp_path / "wh"),
                           partition_by=parts).collect()}
    assert first == again and first["populacao_municipio"] == 11 and first["dim_uf"] == 27
    years = [r.valores for r in pb.partitions(spark, str(tmp_path / "wh" / "populacao_municipio")).collect()]
    assert years and all(v.startswith('{"ano":') for v in years)
