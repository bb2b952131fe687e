import datetime as dt

import pytest

from indistar.plans import datasets as ds
from indistar.plans import reports as rp
from tests.conftest import raw


@pytest.fixture(scope="module")
def model(spark):
    pop = ds.populacao_municipio(ds.long_layer(spark, raw("ibge_populacao_*.json")))
    return {
        "populacao_municipio": ds.populacao_com_crescimento(pop),
        "resumo_ano": ds.resumo_ano(pop),
        "desemprego_uf_trimestre": ds.desemprego_uf_trimestre(ds.long_layer(spark, raw("ibge_desemprego_*.json"))),
        "ipca_area_mes": ds.ipca_area_mes(ds.long_layer(spark, raw("ibge_ipca_*.json"))),
        "dim_uf": ds.dim_uf(spark),
    }


def test_unemployment(model):
    t = {(r.ano, r.uf_sigla): r.taxa_desemprego_media_anual for r in rp.unemployment_table(model).collect()}
    assert t[(2021, "SP")] == pytest.approx((14.9 + 14.2) / 2) and t[(2022, "SP")] == 11.0
    s = rp.unemployment_by_state(model).collect()
    # labels merge years: 1º trimestre = mean(14.9, 11.0), 2º = 14.2
    assert s[0].uf_sigla == "DF" and s[1].taxa_desemprego_media_anual == pytest.approx(((14.9 + 11.0) / 2 + 14.2) / 2)


def test_population_visuals(model):
    m = rp.year_slicer(model, [2021])
    reg = [(r.regiao, r.populacao) for r in rp.population_by_region(m).collect()]
    assert reg == [("Sudeste", 12396372), ("Centro-Oeste", 3094325), ("Norte", 22516)]
    avg = rp.mean_population_by_state(m).collect()
    assert [r.uf_sigla for r in avg] == ["SP", "DF", "RO"]  # Embu-Guacu's null 2021 is ignored
    cnt = {r.uf_sigla: r.contagem_ano for r in rp.year_count_by_state(model).collect()}
    assert cnt == {"SP": 6, "RO": 2, "DF": 3}
    yr = {(r.ano, r.regiao): r.contagem_uf for r in rp.state_count_by_year_region(model).collect()}
    assert (2020, "Norte") not in yr  # no 2020 row for the Norte municipality
    assert yr[(2019, "Sudeste")] == 2


def test_cards_and_slicers(model):
    c = {r.cartao: r.valor for r in rp.cards(rp.year_slicer(model, [2021])).collect()}
    assert c["populacao_total"] == 12396372 + 22516 + 3094325
    assert c["qtd_municipios"] == 4
    assert c["variacao_absoluta_total"] == (12396372 - 12325232) + (3094325 - 3055149)
    sp = rp.attribute_slicer(model, "uf_sigla", ["SP"])
    assert rp.population_by_region(sp).count() == 1
    assert [r.regiao for r in rp.dropdown(model, "regiao").collect()] == ["Centro-Oeste", "Norte", "Sudeste"]


def test_cpi_matrix(model):
    m = rp.cpi_matrix(model, [2024])
    rows = {(r.nivel, r.grupo_ipca): r.ano_2024 for r in m.collect()}
    assert rows[(0, "Índice geral")] == 4.5 and rows[(3, None)] == 4.5


def test_population_page_defaults(model):
    page = rp.population_page(model, regions=["Sudeste", "Norte"], cpi_years=[2024])
    reg = {r.regiao: r.populacao for r in page["populacao_por_regiao"].collect()}
    assert reg == {"Sudeste": 12396372, "Norte": 22516}      # year 2021 by default
    cards = {r.cartao: r.valor for r in page["cartoes"].collect()}
    assert cards["qtd_municipios"] == 4                      # summary is not filtered by region
    assert page["lista_municipios"].count() == 4 and "matriz_ipca" in page


def test_cpi_matrix_order_follows_hidden_count_per_level(spark):
    rows = [("B", "g1", 2024, 1.0)]
    rows += [("A", "g1", 2024, 2.0)] + [("A", "g2", 2024, 3.0)] * 3 + [("A", "g3", 2024, 4.0)] * 2
    f = spark.createDataFrame(rows, "area_ipca string, grupo_ipca string, ano int, acumulado_12_meses_pct double")
    out = [(r.nivel, r.area_ipca, r.grupo_ipca) for r in rp.cpi_matrix({"ipca_area_mes": f}, [2024]).collect()]
    # area A (6 labels) before B (1); groups by count within A; subtotal after its groups; total last
    assert out == [(0, "A", "g2"), (0, "A", "g3"), (0, "A", "g1"), (1, "A", None),
                   (0, "B", "g1"), (1, "B", None), (3, None, None)]
