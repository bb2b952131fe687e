"""Period codes and calendar parts.

Period codes map to the first day of their period: ``yyyy`` (year),
``yyyyMM`` (month), ``yyyyQQ`` (quarter, first month ``(q-1)*3+1``) and
``dd/MM/yyyy`` day text.  Invalid parts give null instead of raising.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: suffix of the quarter label ("1º trimestre").
QUARTER_LABEL_SUFFIX = "º trimestre"
# Fixed value: prefix of the calendar quarter label ("Qtr 1").
CALENDAR_QUARTER_PREFIX = "Qtr "
DAY_FORMAT = "dd/MM/yyyy"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _safe_date(year: Column, month: Column) -> Column:
    # make_date raises on a bad month under ANSI; guard it.
    return F.when(month.between(1, 12), F.make_date(year, month, F.lit(1)))


def annual_period(periodo) -> dict[str, Column]:
    ano = _col(periodo).try_cast("int")
    return {"ano": ano, "data_referencia": _safe_date(ano, F.lit(1))}


def monthly_period(periodo) -> dict[str, Column]:
    p = _col(periodo)
    ano = F.substring(p, 1, 4).try_cast("int")
    mes = F.substring(p, 5, 2).try_cast("int")
    return {"ano": ano, "mes": mes, "data_referencia": _safe_date(ano, mes)}


def quarterly_period(periodo) -> dict[str, Column]:
    p = _col(periodo)
    ano = F.substring(p, 1, 4).try_cast("int")
    q = F.substring(p, 5, 2).try_cast("int")
    first_month = F.when(q.between(1, 4), (q - 1) * 3 + 1)
    return {
        "ano": ano,
        "trimestre_num": q,
        "trimestre": F.concat(q.cast("string"), F.lit(QUARTER_LABEL_SUFFIX)),
        "data_referencia": _safe_date(ano, first_month),
    }


def parse_day(c, fmt: str = DAY_FORMAT) -> Column:
    """Day text -> date; impossible dates (31/02) and junk give null."""
    return F.try_to_date(_col(c), fmt)


def year_month_small(d) -> dict[str, Column]:
    """Year and month of a date as smallint."""
    d = _col(d)
    return {"ano": F.year(d).cast("smallint"), "mes": F.month(d).cast("smallint")}


def date_part(c) -> Column:
    """Date part of a timestamp, used on both sides of a calendar join."""
    return F.to_date(_col(c))


def calendar_columns(d) -> dict[str, Column]:
    """Calendar attributes of a date: year, month no/name, quarter, day."""
    d = _col(d)
    month = F.month(d)
    quarter = F.floor((month + 2) / 3).cast("int")
    return {
        "ano": F.year(d),
        "month_no": month,
        "mes": F.date_format(d, "MMMM"),
        "quarter_no": quarter,
        "trimestre": F.concat(F.lit(CALENDAR_QUARTER_PREFIX), quarter.cast("string")),
        "dia": F.dayofmonth(d),
    }
