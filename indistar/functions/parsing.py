"""Text-to-value parsing and label functions.

All functions return ``Column`` expressions built from Spark built-ins, so
they stay inside whole-stage codegen.  Spark 4 runs with ANSI mode on, so
every cast of untrusted text goes through ``try_cast`` / ``try_*``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

# ---------------------------------------------------------------------------
# Fixed values.  These must equal the published indicator semantics exactly.
# ---------------------------------------------------------------------------
# A value token is numeric when it matches this after trimming.
NUMERIC_TOKEN = r"^[-+]?\d+(?:[.,]\d+)?$"
# Place names carry a trailing " - UF" state suffix.
STATE_SUFFIX = r"\s*-\s*[A-Z]{2}$"
# Group labels start with "N." followed by optional blanks.
GROUP_PREFIX = r"^\d+\.\s*"
# Leading integer of a label.
LEADING_DIGITS = r"^\d+"
# The general index group: its id, display label and sort position.
GENERAL_INDEX_ID = 7169
GENERAL_INDEX_LABEL = "Índice geral"
# Age macro bands: (upper bound of band start, label); anything else -> last.
AGE_BANDS = [
    (14, "0 a 14 anos"),
    (29, "15 a 29 anos"),
    (59, "30 a 59 anos"),
]
AGE_BAND_LAST = "60 anos ou mais"
# Region colour switch, default grey.
REGION_COLORS = {
    "Norte": "#eb6834",
    "Nordeste": "#e87ba4",
    "Centro-Oeste": "#eda100",
    "Sudeste": "#2a78d6",
    "Sul": "#1baf7a",
}
REGION_COLOR_DEFAULT = "#898781"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_number(c) -> Column:
    """Tolerant numeric parse: trim, accept ``[-+]d[.,d]``, comma -> point.

    Anything else (``...``, ``-``, ``1.234,56``, empty, null) becomes null.
    """
    t = F.trim(_col(c))
    return F.when(t.rlike(NUMERIC_TOKEN),
                  F.regexp_replace(t, ",", ".").try_cast("double"))


def parse_decimal(c, precision: int = 20, scale: int = 8) -> Column:
    """Lenient decimal parse: comma -> point, then cast; bad text -> null."""
    return F.regexp_replace(_col(c), ",", ".").try_cast(DecimalType(precision, scale))


def strip_state_suffix(c) -> Column:
    """``"Name - XX"`` -> ``"Name"`` (inner hyphens are kept)."""
    return F.regexp_replace(_col(c), STATE_SUFFIX, "")


def code_prefix(c, digits: int = 2) -> Column:
    """First ``digits`` characters of a code as int (state id of a place id)."""
    return F.substring(_col(c).cast("string"), 1, digits).try_cast("int")


def leading_number(c) -> Column:
    """Leading digits of a label as int; null when the label has none."""
    return F.regexp_substr(_col(c), F.lit(LEADING_DIGITS)).try_cast("int")


def group_order(label, group_id, general_id: int = GENERAL_INDEX_ID) -> Column:
    """Sort position of a group: 0 for the general index, else leading number."""
    return F.when(_col(group_id) == F.lit(general_id), F.lit(0)) \
        .otherwise(leading_number(label))


def group_name(label, group_id, general_id: int = GENERAL_INDEX_ID,
               general_label: str = GENERAL_INDEX_LABEL) -> Column:
    """Group label without its ``N.`` prefix; fixed label for the general index."""
    return F.when(_col(group_id) == F.lit(general_id), F.lit(general_label)) \
        .otherwise(F.regexp_replace(_col(label), GROUP_PREFIX, ""))


def age_band(start, unknown_label: str | None = None) -> Column:
    """Map an age-band start to its macro band.

    As published, a null start falls through to the last band; pass
    ``unknown_label`` to give unknown starts their own label instead.
    """
    s = _col(start)
    expr = None
    if unknown_label is not None:
        expr = F.when(s.isNull(), F.lit(unknown_label))
    for upper, label in AGE_BANDS:
        expr = F.when(s <= upper, F.lit(label)) if expr is None \
            else expr.when(s <= upper, F.lit(label))
    return expr.otherwise(F.lit(AGE_BAND_LAST))


def region_color(region) -> Column:
    """Literal switch region -> colour with a grey default (nulls included)."""
    r = _col(region)
    expr = None
    for name, colour in REGION_COLORS.items():
        expr = F.when(r == name, F.lit(colour)) if expr is None \
            else expr.when(r == name, F.lit(colour))
    return expr.otherwise(F.lit(REGION_COLOR_DEFAULT))
