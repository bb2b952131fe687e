import datetime as dt

from pyspark.sql import functions as F

from indistar.operators import flatten as fl
from indistar.plans import datasets as ds
from indistar.plans.tables import TABLE_CONTRACTS
from indistar.operators.contracts import violations
from tests.conftest import raw


def test_flatten_drops_null_and_empty(spark):
    long = ds.long_layer(spark, raw("ibge_pib_*.json"))
    # 3 variables x 2 years; the variable with null results vanishes
    assert long.count() == 6
    assert set(long.columns) == set(fl.LONG_COLUMNS)
    fx = ds.long_layer(spark, raw("ibge_faixa_etaria_*.json"))
    assert fx.count() == 4  # the result with empty series gives no row


def test_populacao_municipio(spark):
    pop = ds.populacao_municipio(ds.long_layer(spark, raw("ibge_populacao_*.json")))
    rows = {(r.municipio_id, r.ano): r for r in pop.collect()}
    assert rows[(3515004, 2021)].populacao is None  # "..." kept as null
    assert rows[(3515004, 2020)].municipio_nome == "Embu-Guacu"
    assert rows[(1100015, 2019)].uf_id == 11
    assert rows[(3550308, 2021)].data_referencia == dt.date(2021, 1, 1)
    dims = {"dim_uf": ds.dim_uf(spark)}
    bad = [r for r in violations(TABLE_CONTRACTS["populacao_municipio"], pop, dims).collect() if r.violacoes]
    assert bad == []


def test_pib_split_types(spark):
    t = ds.pib_tables(ds.long_layer(spark, raw("ibge_pib_*.json")))
    assert t["PIB_pessoas"].schema["populacao_mil_pessoas"].dataType.simpleString() == "bigint"
    assert t["PIB_financeiro"].schema["valor_financeiro"].dataType.simpleString() == "decimal(20,2)"
    pct = sorted(float(r.valor_percentual) for r in t["PIB_percentual"].collect())
    assert pct == [-3.3, 4.8]
    full = ds.pib_brasil_ano(ds.long_layer(spark, raw("ibge_pib_*.json")))
    assert full.count() == 6 and full.first().pais_nome == "Brasil"


def test_faixa_etaria(spark):
    f = ds.faixa_etaria_uf(ds.long_layer(spark, raw("ibge_faixa_etaria_*.json")))
    rows = {(r.sexo, r.faixa_etaria): r for r in f.collect()}
    assert rows[("Homens", "0 a 4 anos")].faixa_macro == "0 a 14 anos"
    assert rows[("Mulheres", "15 a 19 anos")].faixa_etaria_ordem == 15
    assert rows[("Total", "100 anos ou mais")].faixa_macro == "60 anos ou mais"
    assert rows[("Homens", "Menos de 1 ano")].faixa_etaria_ordem is None
    assert rows[("Homens", "Menos de 1 ano")].faixa_macro == "60 anos ou mais"


def test_category_lookup_no_match(spark):
    long = ds.long_layer(spark, raw("ibge_faixa_etaria_*.json"))
    vals = long.select(fl.category_of("classificacoes", 999).alias("c")).collect()
    assert all(r.c is None for r in vals)
    k = [r.k for r in long.select(fl.category_of("classificacoes", 286)["key"].alias("k")).collect()]
    assert sorted(k, key=lambda x: (x is None, x)) == ["113635", None, None, None]


def test_desemprego_pivot(spark):
    d = ds.desemprego_uf_trimestre(ds.long_layer(spark, raw("ibge_desemprego_*.json")))
    rows = {(r.uf_id, r.trimestre_num, r.ano): r for r in d.collect()}
    assert rows[(35, 1, 2021)].taxa_desocupacao_pct == 14.9
    assert rows[(35, 2, 2021)].taxa_subutilizacao_pct == 26.0
    assert rows[(35, 1, 2022)].taxa_subutilizacao_pct is None  # key row survives
    assert rows[(53, 2, 2021)].taxa_desocupacao_pct is None
    assert rows[(35, 2, 2021)].trimestre == "2º trimestre"


def test_ipca(spark):
    i = ds.ipca_area_mes(ds.long_layer(spark, raw("ibge_ipca_*.json")))
    rows = {(r.grupo_ipca_id, r.mes): r for r in i.collect()}
    g = rows[(7169, 1)]
    assert (g.grupo_ipca, g.grupo_ipca_ordem, g.variacao_mensal_pct, g.acumulado_12_meses_pct) == \
        ("Índice geral", 0, 0.42, 4.51)
    a = rows[(7170, 2)]
    assert (a.grupo_ipca, a.grupo_ipca_ordem, a.variacao_mensal_pct) == ("Alimentacao e bebidas", 1, None)
    assert a.acumulado_12_meses_pct is None and a.area_ipca == "Belem - PA"


def test_bacen_keep_newest_snapshot(spark, tmp_path):
    import os
    import shutil
    for i, name in enumerate(["bacen_selic_meta_432_20240101_000000.json",
                              "bacen_selic_meta_432_20240301_000000.json",
                              "bacen_cdi_12_20240101_000000.json"]):
        dst = tmp_path / name
        shutil.copy(raw(name), dst)
        os.utime(dst, (1_700_000_000 + i * 1000, 1_700_000_000 + i * 1000))
    h = ds.bacen_serie_historica(spark, [str(tmp_path / "*.json")])
    rows = {(r.serie_id, r.data_referencia): r for r in h.collect()}
    assert float(rows[(432, dt.date(2024, 2, 2))].valor) == 11.50  # newer file wins
    assert (432, dt.date(2024, 2, 3)) in rows and len([k for k in rows if k[0] == 432]) == 3
    # 31/02 dropped; '1/2/2024' is not dd/MM/yyyy; '1.234,56' and '' are not decimals
    assert [k for k in rows if k[0] == 12] == [(12, dt.date(2024, 2, 1))]
    r = rows[(12, dt.date(2024, 2, 1))]
    assert (r.indicador, r.unidade, r.ano, r.mes) == ("Taxa de juros CDI", "% a.d.", 2024, 2)
    per = ds.bacen_per_series(h)
    assert per["cdi"].count() == 1 and per["dolar_venda"].count() == 0


def test_resumo_ano_and_calendar(spark):
    pop = ds.populacao_municipio(ds.long_layer(spark, raw("ibge_populacao_*.json")))
    r = {x.ano: x for x in ds.resumo_ano(pop).collect()}
    y20 = r[dt.date(2020, 1, 1)]
    assert y20.populacao_total == 12325232 + 69385 + 3055149
    assert y20.qtd_municipios == 3  # 1100015 has no 2020 period
    # 1100015 has no 2020 value and Embu 2021 is null: total change telescopes only over pairs
    y21 = r[dt.date(2021, 1, 1)]
    assert y21.variacao_absoluta_total == (12396372 - 12325232) + (3094325 - 3055149)
    assert r[dt.date(2019, 1, 1)].crescimento_medio_pct is None
    cal = ds.calendar_for(pop, "data_referencia")
    assert cal.count() == 365 + 366 + 365
    st = ds.with_state(pop, ds.dim_uf(spark)).filter(F.col("municipio_id") == 5300108).first()
    assert (st.uf_sigla, st.regiao) == ("DF", "Centro-Oeste")


def test_bacen_latest_extraction_by_name_stamp(spark, tmp_path):
    """The stamp in the file name decides, even when the older extraction
    was copied (touched) after the newer one."""
    import os
    import shutil
    for name, mtime in [("bacen_selic_meta_432_20240101_000000.json", 1_700_009_000),
                        ("bacen_selic_meta_432_20240301_000000.json", 1_700_000_000)]:
        dst = tmp_path / name
        shutil.copy(raw(name), dst)
        os.utime(dst, (mtime, mtime))
    rows = {(r.serie_id, r.data_referencia): r for r in
            ds.bacen_serie_historica(spark, [str(tmp_path / "*.json")]).collect()}
    assert float(rows[(432, dt.date(2024, 2, 2))].valor) == 11.50  # 20240301 extraction wins
