"""Every landed file and record is used, or the run stops and names it."""

import datetime as dt
import os
import shutil

import pytest
from pyspark.errors import StreamingQueryException

from indistar.operators import publish as pb
from indistar.plans import jobs
from indistar.sources import intake
from indistar.sources import readers as rd
from indistar.sources import snapshots as sn
from indistar.sources.schemas import FLAT_ITEM_SCHEMA
from indistar.streaming import ingest_landed_series
from tests.conftest import RAW

BAD = {
    "corrompido": '[{"serie": "cdi", "codigo": 12, "data": "01/03/2024"',
    "sem_dados": '[{"erro": "sem dados"}]',
    "serie_desconhecida": '[{"serie": "xyz", "codigo": 99, "data": "01/03/2024", "valor": "1"}]',
    "sem_registro": "[]",
    "vazio": "",
}


@pytest.fixture()
def landing(tmp_path):
    d = tmp_path / "raw"
    d.mkdir()
    for n in os.listdir(RAW):
        if n.startswith("bacen"):
            shutil.copy(os.path.join(RAW, n), d / n)
    return d


@pytest.mark.parametrize("problem", sorted(BAD))
def test_job_and_stream_stop_and_name_the_file(spark, landing, tmp_path, problem):
    name = "bacen_cdi_12_20240401_000000.json"
    (landing / name).write_text(BAD[problem])
    with pytest.raises(intake.IntakeError, match=name):
        jobs.run_bacen(spark, str(landing), str(tmp_path / "wh"), ["selic_meta", "cdi"])
    assert pb.read_current(spark, str(tmp_path / "wh" / "bacen_serie_historica")) is None
    with pytest.raises(StreamingQueryException, match=name):
        ingest_landed_series(spark, str(landing), str(tmp_path / "s"), str(tmp_path / "ck")).awaitTermination()
    assert pb.read_current(spark, str(tmp_path / "s")) is None
    (landing / name).unlink()  # mended: the same checkpoint goes on
    ingest_landed_series(spark, str(landing), str(tmp_path / "s"), str(tmp_path / "ck2")).awaitTermination()
    assert pb.read_current(spark, str(tmp_path / "s")).count() == 4


def test_quarantine_keeps_the_rest(spark, landing, tmp_path):
    for i, text in enumerate(BAD.values()):
        (landing / f"bacen_cdi_12_2024040{i + 1}_000000.json").write_text(text)
    counts = {r.tabela: r.linhas for r in jobs.run_bacen(
        spark, str(landing), str(tmp_path / "wh"), ["selic_meta", "cdi"], on_problem="quarantine").collect()}
    assert counts == {"bacen_serie_historica": 4, "bacen_selic_meta": 3, "bacen_cdi": 1}
    listing = sn.snapshot_listing(spark, str(landing)).select("arquivo_caminho").union(sn.empty_documents(spark, str(landing)))
    known = spark.createDataFrame([("cdi", 12), ("selic_meta", 432)], "serie string, codigo int")
    taken = intake.take_in(rd.read_landing_folder(spark, str(landing), FLAT_ITEM_SCHEMA), str(tmp_path / "q"), known,
                           ["serie", "codigo"], listing, "quarantine")
    got = sorted(r.problema for r in taken.report.collect())
    assert got == sorted(["corrompido", "sem_dados", "serie_desconhecida", "sem_registro", "sem_registro"])
    assert taken.counts["corrompido"] == 1 and taken.quarantine.count() == 3


def test_selected_series_without_a_snapshot(spark, landing, tmp_path):
    with pytest.raises(FileNotFoundError, match="dolar_venda"):
        jobs.run_bacen(spark, str(landing), str(tmp_path / "wh"), ["cdi", "dolar_venda"])


def test_runs_are_landed_and_read_back(spark, tmp_path):
    raw, kind = str(tmp_path / "raw"), "serie string, codigo int, data string, valor string"
    first = spark.createDataFrame([("cdi", 12, "01/02/2024", "1,5"), ("cdi", 12, "02/02/2024", "2,5"),
                                   ("cdi", 12, "02/02/2024", "2,0"), ("selic_meta", 432, "01/02/2024", "11")], kind)
    again = spark.createDataFrame([("cdi", 12, "02/02/2024", "9,0"), ("cdi", 12, "03/02/2024", None)], kind)
    for df, stamp in ((first, "20240301_000000"), (again, "20240302_000000")):
        pb.land_series(df, raw, "bacen", ["codigo", "data"], ["valor"], stamp)
    with pytest.raises(FileExistsError):
        pb.land_series(first, raw, "bacen", ["codigo", "data"], ["valor"], "20240301_000000")
    assert os.path.isdir(f"{raw}/fonte=bacen/dataset=cdi/codigo=12/run=20240302_000000")
    shutil.copy(os.path.join(RAW, "bacen_selic_meta_432_20240301_000000.json"), raw)  # both layouts in one folder
    out = str(tmp_path / "wh")
    jobs.run_bacen(spark, raw, out, ["cdi", "selic_meta"])
    hist = {(r.serie, r.data_referencia): float(r.valor) for r in pb.read_current(spark, out + "/bacen_serie_historica").collect()}
    assert hist[("cdi", dt.date(2024, 2, 1))] == 1.5 and hist[("cdi", dt.date(2024, 2, 2))] == 9.0
    assert len([k for k in hist if k[0] == "cdi"]) == 2 and hist[("selic_meta", dt.date(2024, 2, 1))] == 11.0
    newest = sn.newest_snapshots(spark, raw, {"cdi": 12}, "bacen")
    assert newest["cdi"].endswith("/codigo=12/run=20240302_000000")
    ingest_landed_series(spark, raw, str(tmp_path / "s"), str(tmp_path / "ck")).awaitTermination()
    assert {(r.serie, r.data_referencia): float(r.valor) for r in pb.read_current(spark, str(tmp_path / "s")).collect()} == hist


def test_legacy_names_and_sources(spark, tmp_path):
    (tmp_path / "ibge_agregado_6784_20240101_000000.json").write_text("[]")
    (tmp_path / "ibge_pib_6784_20230101_000000.json").write_text("[]")
    os.utime(tmp_path / "ibge_pib_6784_20230101_000000.json", (1, 1))
    got = sn.newest_snapshots(spark, str(tmp_path), {"pib": 6784})
    assert got["pib"].endswith("ibge_agregado_6784_20240101_000000.json")
    with pytest.raises(FileNotFoundError):  # the legacy name is theirs only
        sn.newest_snapshots(spark, str(tmp_path), {"ipca": 6784})
    (tmp_path / "outra_pib_6784_20240101_000000.json").write_text("[]")
    with pytest.raises(ValueError):
        sn.newest_snapshots(spark, str(tmp_path), {"pib": 6784})
    assert sn.newest_snapshots(spark, str(tmp_path), {"pib": 6784}, "outra")["pib"].endswith("outra_pib_6784_20240101_000000.json")
