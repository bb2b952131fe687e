"""Declared contracts of the published tables (keys, FKs, ranges, types)."""

from __future__ import annotations

from pyspark.sql import types as T

from ..operators.contracts import Contract

S, I, L, D = T.StringType(), T.IntegerType(), T.LongType(), T.DateType()


def _f(name, dtype, nullable=False):
    return T.StructField(name, dtype, nullable)


def _dec(p, s):
    return T.DecimalType(p, s)


_PIB = [_f("variavel_id", I), _f("variavel_nome", S), _f("unidade", S), _f("data_referencia", D), _f("ano", I)]
_BACEN = T.StructType([
    _f("serie_id", I), _f("serie", S), _f("indicador", S), _f("unidade", S), _f("periodicidade", S),
    _f("data_referencia", D), _f("ano", T.ShortType()), _f("mes", T.ShortType()), _f("valor", _dec(20, 8))])

TABLE_CONTRACTS: dict[str, Contract] = {
    "dim_uf": Contract(
        "dim_uf", T.StructType([_f("uf_id", T.ShortType()), _f("uf_sigla", S), _f("uf_nome", S), _f("regiao", S)]),
        key=["uf_id"], not_null=["uf_id", "uf_sigla", "uf_nome", "regiao"],
        unique=[["uf_sigla"], ["uf_nome"]], max_length={"uf_sigla": 2, "uf_nome": 30, "regiao": 20}),
    "populacao_municipio": Contract(
        "populacao_municipio", T.StructType([
            _f("data_referencia", D), _f("ano", I), _f("municipio_id", I), _f("municipio_nome", S),
            _f("uf_id", I), _f("populacao", L, True)]),
        key=["data_referencia", "municipio_id"],
        not_null=["data_referencia", "ano", "municipio_id", "municipio_nome", "uf_id"],
        foreign_keys=[(["uf_id"], "dim_uf", ["uf_id"])], year_of_date=("ano", "data_referencia"),
        max_length={"municipio_nome": 150}),
    "PIB_pessoas": Contract(
        "PIB_pessoas", T.StructType(_PIB + [_f("populacao_mil_pessoas", L)]),
        key=["data_referencia", "variavel_id"],
        not_null=["variavel_id", "variavel_nome", "unidade", "data_referencia", "ano", "populacao_mil_pessoas"],
        year_of_date=("ano", "data_referencia"), max_length={"unidade": 50}),
    "PIB_financeiro": Contract(
        "PIB_financeiro", T.StructType(_PIB + [_f("valor_financeiro", _dec(20, 2))]),
        key=["data_referencia", "variavel_id"],
        not_null=["variavel_id", "variavel_nome", "unidade", "data_referencia", "ano", "valor_financeiro"],
        year_of_date=("ano", "data_referencia"), max_length={"unidade": 50}),
    "PIB_percentual": Contract(
        "PIB_percentual", T.StructType(_PIB + [_f("valor_percentual", _dec(10, 2))]),
        key=["data_referencia", "variavel_id"],
        not_null=["variavel_id", "variavel_nome", "unidade", "data_referencia", "ano", "valor_percentual"],
        year_of_date=("ano", "data_referencia"), max_length={"unidade": 50}),
    "faixa_etaria_uf": Contract(
        "faixa_etaria_uf", T.StructType([
            _f("data_referencia", D), _f("ano", I), _f("uf_id", I), _f("sexo_id", I), _f("sexo", S),
            _f("faixa_etaria_id", I), _f("faixa_etaria", S), _f("faixa_etaria_ordem", I, True),
            _f("faixa_macro", S), _f("populacao", L)]),
        key=["data_referencia", "uf_id", "sexo_id", "faixa_etaria_id"],
        not_null=["data_referencia", "ano", "uf_id", "sexo_id", "sexo", "faixa_etaria_id", "faixa_etaria",
                  "faixa_macro", "populacao"],
        foreign_keys=[(["uf_id"], "dim_uf", ["uf_id"])], year_of_date=("ano", "data_referencia"),
        max_length={"sexo": 20, "faixa_etaria": 40, "faixa_macro": 30}),
    "desemprego_uf_trimestre": Contract(
        "desemprego_uf_trimestre", T.StructType([
            _f("data_referencia", D), _f("ano", I), _f("trimestre_num", I), _f("trimestre", S), _f("uf_id", I),
            _f("taxa_desocupacao_pct", _dec(10, 2), True), _f("taxa_subutilizacao_pct", _dec(10, 2), True)]),
        key=["data_referencia", "uf_id"],
        not_null=["data_referencia", "ano", "trimestre_num", "trimestre", "uf_id"],
        foreign_keys=[(["uf_id"], "dim_uf", ["uf_id"])], year_of_date=("ano", "data_referencia"),
        ranges={"trimestre_num": (1, 4)}, max_length={"trimestre": 20}),
    "ipca_area_mes": Contract(
        "ipca_area_mes", T.StructType([
            _f("data_referencia", D), _f("ano", I), _f("mes", I), _f("area_ipca_id", I), _f("area_ipca", S),
            _f("nivel_id", S), _f("grupo_ipca_id", I), _f("grupo_ipca", S), _f("grupo_ipca_ordem", I),
            _f("variacao_mensal_pct", _dec(10, 2), True), _f("acumulado_ano_pct", _dec(10, 2), True),
            _f("acumulado_12_meses_pct", _dec(10, 2), True), _f("peso_mensal_pct", _dec(10, 2), True)]),
        key=["data_referencia", "area_ipca_id", "grupo_ipca_id"],
        not_null=["data_referencia", "ano", "mes", "area_ipca_id", "area_ipca", "nivel_id", "grupo_ipca_id",
                  "grupo_ipca", "grupo_ipca_ordem"],
        year_of_date=("ano", "data_referencia"), ranges={"mes": (1, 12)},
        max_length={"area_ipca": 100, "nivel_id": 10, "grupo_ipca": 100}),
    "bacen_serie_historica": Contract(
        "bacen_serie_historica", _BACEN, key=["serie_id", "data_referencia"],
        not_null=_BACEN.fieldNames(), year_of_date=("ano", "data_referencia"), ranges={"mes": (1, 12)},
        max_length={"serie": 50, "indicador": 150, "unidade": 30, "periodicidade": 20}),
}


def series_contract(name: str, code: int) -> Contract:
    """Contract of one per-series table: the series id is fixed."""
    base = TABLE_CONTRACTS["bacen_serie_historica"]
    return Contract(f"bacen_{name}", base.schema, key=base.key, not_null=base.not_null,
                    year_of_date=base.year_of_date, ranges=dict(base.ranges), fixed={"serie_id": code},
                    max_length=dict(base.max_length))
