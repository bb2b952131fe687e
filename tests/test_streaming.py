import datetime as dt
import os
import shutil

from indistar.operators import publish as pb
from indistar.streaming import ingest_landed_series
from tests.conftest import RAW


def _land(src, dst_dir, mtime):
    dst = os.path.join(dst_dir, src)
    shutil.copy(os.path.join(RAW, src), dst)
    os.utime(dst, (mtime, mtime))


def test_incremental_ingest_merges_new_snapshots(spark, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    root = str(tmp_path / "bacen")
    ckpt = str(tmp_path / "ckpt")
    _land("bacen_selic_meta_432_20240101_000000.json", landing, 1_700_000_000)
    _land("bacen_cdi_12_20240101_000000.json", landing, 1_700_000_000)
    ingest_landed_series(spark, str(landing), root, ckpt).awaitTermination()
    first = {(r.serie_id, r.data_referencia): float(r.valor) for r in pb.read_current(spark, root).collect()}
    assert first[(432, dt.date(2024, 2, 2))] == 11.25 and len(first) == 3
    _land("bacen_selic_meta_432_20240301_000000.json", landing, 1_700_001_000)
    ingest_landed_series(spark, str(landing), root, ckpt).awaitTermination()
    second = {(r.serie_id, r.data_referencia): float(r.valor) for r in pb.read_current(spark, root).collect()}
    assert second[(432, dt.date(2024, 2, 2))] == 11.50      # newer snapshot overwrote the key
    assert second[(432, dt.date(2024, 2, 1))] == 11.25      # untouched key kept
    assert len(second) == 4
    # nothing new: the table stays as it is
    ingest_landed_series(spark, str(landing), root, ckpt).awaitTermination()
    assert {(r.serie_id, r.data_referencia): float(r.valor) for r in pb.read_current(spark, root).collect()} == second


def test_incremental_ingest_rewrites_only_touched_partitions(spark, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    root = str(tmp_path / "bacen_part")
    ckpt = str(tmp_path / "ckpt_part")
    _land("bacen_selic_meta_432_20240101_000000.json", landing, 1_700_000_000)
    _land("bacen_cdi_12_20240101_000000.json", landing, 1_700_000_000)
    ingest_landed_series(spark, str(landing), root, ckpt, partition_by=["ano"]).awaitTermination()
    first = {(r.serie_id, r.data_referencia): float(r.valor) for r in pb.read_current(spark, root).collect()}
    assert first[(432, dt.date(2024, 2, 2))] == 11.25 and len(first) == 3
    _land("bacen_selic_meta_432_20240301_000000.json", landing, 1_700_001_000)
    ingest_landed_series(spark, str(landing), root, ckpt, partition_by=["ano"]).awaitTermination()
    second = {(r.serie_id, r.data_referencia): float(r.valor) for r in pb.read_current(spark, root).collect()}
    assert second[(432, dt.date(2024, 2, 2))] == 11.50 and second[(432, dt.date(2024, 2, 1))] == 11.25
    assert len(second) == 4
    assert [r.valores for r in pb.partitions(spark, root).collect()] == ['{"ano":2024}']
