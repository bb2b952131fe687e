"""End-to-end jobs: landed snapshots -> long layer -> checked, published tables.

Stage 1 reads the newest snapshot of every selected dataset in ONE scan and
writes the long layer as Parquet partitioned by dataset, so every recipe in
stage 2 reads only its partition (partition pruning) instead of re-parsing
JSON once per output table.  Stage 2 builds each table, checks its contract
against the published dimension, and merges it into its published version
(snapshot upsert by key) or replaces it.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import commits as cm
from ..operators import contracts as ct
from ..operators import flatten as fl
from ..operators import publish as pb
from ..sources import catalog as cat
from ..sources import readers as rd
from ..sources import snapshots as sn
from ..sources.intake import take_in
from ..sources.schemas import FLAT_ITEM_SCHEMA, NESTED_VARIABLE_SCHEMA
from . import datasets as ds
from .tables import TABLE_CONTRACTS, series_contract

# Which published tables each nested dataset feeds.
IBGE_OUTPUTS = {
    "populacao": ["populacao_municipio"],
    "pib": ["PIB_pessoas", "PIB_financeiro", "PIB_percentual", "pib_brasil_ano"],
    "faixa_etaria": ["faixa_etaria_uf"],
    "desemprego": ["desemprego_uf_trimestre"],
    "ipca": ["ipca_area_mes"],
}
KEYS = {name: list(c.key) for name, c in TABLE_CONTRACTS.items()}
KEYS["pib_brasil_ano"] = ["data_referencia", "variavel_id"]


def _empty(spark: SparkSession, raw_dir: str, chosen: dict) -> DataFrame:
    """Documents of zero bytes that belong to the chosen datasets."""
    path, codes = F.col("arquivo_caminho"), {n: c.get("agregado", c.get("codigo")) for n, c in chosen.items()}
    return sn.empty_documents(spark, raw_dir).filter(sn.dataset_of(path, codes).isin(list(chosen)))


def stage_long_layer(spark: SparkSession, raw_dir: str, long_root: str,
                     datasets: Iterable[str] | str | None = None, spread: int | bool | None = True) -> dict[str, str]:
    """Newest snapshot per selected dataset -> long layer partitioned by dataset.

    A dataset is one document, read by one task, so its series are spread over
    the shuffle's partitions before their periods are exploded."""
    chosen = sn.select_datasets(cat.INDICATORS, datasets)
    paths = sn.newest_snapshots(spark, raw_dir, {n: c["agregado"] for n, c in chosen.items()})
    raw = rd.read_landed(spark, paths.values(), NESTED_VARIABLE_SCHEMA)
    listed = sn.snapshot_listing(spark, raw_dir).join(
        spark.createDataFrame([(p,) for p in paths.values()], "instantaneo string"), "instantaneo", "left_semi")
    listed = listed.select("arquivo_caminho").union(_empty(spark, raw_dir, chosen))
    taken = take_in(raw, f"{long_root.rstrip('/')}-registros/{uuid.uuid4().hex}", listed=listed)
    good = taken.good.withColumn("dataset", sn.dataset_of(
        F.col("arquivo_caminho"), {n: c["agregado"] for n, c in chosen.items()}))
    long = fl.flatten_nested(good, carry=["dataset"], spread=spread)
    (long.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("dataset").parquet(long_root))
    return paths


def _long(spark: SparkSession, long_root: str, dataset: str) -> DataFrame:
    return spark.read.parquet(long_root).filter(F.col("dataset") == dataset).drop("dataset")


def build_ibge_tables(spark: SparkSession, long_root: str,
                      datasets: Iterable[str] | str | None = None) -> dict[str, DataFrame]:
    chosen = sn.select_datasets(cat.INDICATORS, datasets)
    out: dict[str, DataFrame] = {"dim_uf": ds.dim_uf(spark)}
    for name in chosen:
        long = _long(spark, long_root, name)
        if name == "populacao":
            out["populacao_municipio"] = ds.populacao_municipio(long)
        elif name == "pib":
            out.update(ds.pib_tables(long))
            out["pib_brasil_ano"] = ds.pib_brasil_ano(long)
        elif name == "faixa_etaria":
            out["faixa_etaria_uf"] = ds.faixa_etaria_uf(long)
        elif name == "desemprego":
            out["desemprego_uf_trimestre"] = ds.desemprego_uf_trimestre(long)
        elif name == "ipca":
            out["ipca_area_mes"] = ds.ipca_area_mes(long)
    return out


def publish_tables(spark: SparkSession, tables: dict[str, DataFrame], out_root: str,
                   mode: str = "upsert", csv_root: str | None = None,
                   partition_by: dict[str, list[str]] | None = None) -> DataFrame:
    """Merge or replace every table aside, check what was written (C11: no
    table changes while any check fails) and publish all in one commit; return
    post-load row counts (K6).

    Tables named in ``partition_by`` (large facts, e.g.
    ``{"populacao_municipio": ["ano"]}``; the columns must follow from the
    key) are merged partition by partition: a run rewrites only the partitions
    its rows fall in, and only those are checked again.
    """
    partition_by = partition_by or {}
    changes = cm.Changes(spark, out_root)
    for name, df in tables.items():
        if mode == "upsert":
            changes.upsert(name, df, KEYS[name], partition_by.get(name, ()))
        else:
            changes.replace(name, df, partition_by.get(name, ()))
    written = {name: changes.staged(name) for name in tables}
    dims = {"dim_uf": written.get("dim_uf", cat.state_dimension(spark))}
    for name, df in written.items():
        contract = TABLE_CONTRACTS.get(name)
        if contract is not None:
            ct.assert_contract(contract, df, dims)
        elif n := pb.repeated_keys(df, KEYS[name]):
            raise ValueError(f"{name}: {n} duplicate keys in {KEYS[name]}")
    changes.commit()
    roots = {name: f"{out_root.rstrip('/')}/{name}" for name in tables}
    if csv_root:
        for name, root in roots.items():
            pb.write_table(pb.read_current(spark, root), f"{csv_root.rstrip('/')}/{name}", fmt="csv")
    return pb.post_load_counts(spark, roots)


def run_ibge(spark: SparkSession, raw_dir: str, work_root: str, out_root: str,
             datasets: Iterable[str] | str | None = None, mode: str = "upsert",
             csv_root: str | None = None, partition_by: dict[str, list[str]] | None = None) -> DataFrame:
    long_root = f"{work_root.rstrip('/')}/long"
    stage_long_layer(spark, raw_dir, long_root, datasets)
    return publish_tables(spark, build_ibge_tables(spark, long_root, datasets), out_root, mode, csv_root,
                          partition_by)


def run_bacen(spark: SparkSession, raw_dir: str, out_root: str,
              series: Iterable[str] | str | None = None, start=None, end=None,
              all_snapshots: bool = True, catalog: dict | None = None, fonte: str | None = None,
              on_problem: str = "fail") -> DataFrame:
    """Daily series job: every landed snapshot (or only the newest) of the
    selected series, optional inclusive date bound, merged into the history
    and into one table per series.

    Input is accounted for (``take_in``): a snapshot that does not parse, has
    no record or holds another series stops the run before anything is
    published, and so does a selected series without a snapshot; with
    ``on_problem="quarantine"`` such records are set aside instead."""
    catalog = cat.SERIES if catalog is None else catalog
    chosen = sn.select_datasets(catalog, series)
    changes = cm.Changes(spark, out_root)
    listing = sn.snapshot_listing(spark, raw_dir, fonte).filter(F.col("dataset").isin(list(chosen)))
    if all_snapshots:
        landed = {r["dataset"] for r in listing.select("dataset").distinct().collect()}  # at most one a series
        if missing := sorted(set(chosen) - landed):
            raise FileNotFoundError(f"no landed snapshot for {missing}")
        raw = rd.read_landing_folder(spark, raw_dir, FLAT_ITEM_SCHEMA)
        path = F.col("arquivo_caminho")
        raw = raw.filter(sn.snapshot_field(path, "dataset").isin(list(chosen)))
        if fonte is not None:
            raw = raw.filter(sn.snapshot_field(path, "fonte") == fonte)
    else:
        paths = sn.newest_snapshots(spark, raw_dir, {n: c["codigo"] for n, c in chosen.items()}, fonte)
        listing = listing.filter(F.col("instantaneo").isin(list(paths.values())))
        raw = rd.read_landed(spark, paths.values(), FLAT_ITEM_SCHEMA)
    known = spark.createDataFrame([(n, c["codigo"]) for n, c in chosen.items()], "serie string, codigo int")
    listed = listing.select("arquivo_caminho").union(_empty(spark, raw_dir, chosen))
    taken = take_in(raw, changes.aside("registros"), known, ["serie", "codigo"], listed, on_problem)
    hist = ds.bacen_from_raw(taken.good, chosen)
    if start is not None or end is not None:
        hist = cat.date_range(hist, "data_referencia", start, end)
    order = ["serie_id", "data_referencia"]  # files sorted per task
    history, keys = "bacen_serie_historica", KEYS["bacen_serie_historica"]
    once = changes.evaluated(hist)  # the raw documents are read once for all tables
    ct.assert_contract(TABLE_CONTRACTS[history], once)
    changes.upsert(history, once, keys, sort_within=order)
    for name, df in ds.bacen_per_series(once, chosen).items():
        ct.assert_contract(series_contract(name, chosen[name]["codigo"]), df)
        changes.upsert(f"bacen_{name}", df, keys, sort_within=order)
    changes.commit()
    return pb.post_load_counts(spark, {n: f"{out_root.rstrip('/')}/{n}" for n in (history, *(f"bacen_{c}" for c in chosen))})


def load_csv_tables(spark: SparkSession, csv_root: str, out_root: str,
                    tables: Iterable[str] | str | None = None) -> DataFrame:
    """CSV extracts -> warehouse tables by full refresh.

    Every selected file is read with its contract schema (a missing file or
    a header that differs from the contract fails here), every contract is
    checked, and only then each table is switched; returns post-load counts.
    """
    chosen = sn.select_datasets(TABLE_CONTRACTS, tables)
    frames = {name: (rd.read_csv_typed(spark, f"{csv_root.rstrip('/')}/{name}", c.schema), c)
              for name, c in chosen.items()}
    dims = {"dim_uf": frames["dim_uf"][0] if "dim_uf" in frames else cat.state_dimension(spark)}
    versions = pb.full_refresh(spark, frames, out_root, dims=dims)
    return pb.post_load_counts(spark, {n: f"{out_root.rstrip('/')}/{n}" for n in versions})
