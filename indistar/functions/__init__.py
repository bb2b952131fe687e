"""Column-level building blocks (pure expressions, ANSI-safe)."""

from .parsing import (  # noqa: F401
    AGE_BANDS, GENERAL_INDEX_ID, GENERAL_INDEX_LABEL, REGION_COLORS,
    age_band, code_prefix, group_name, group_order, leading_number,
    parse_decimal, parse_number, region_color, strip_state_suffix,
)
from .periods import (  # noqa: F401
    annual_period, calendar_columns, date_part, monthly_period,
    parse_day, quarterly_period, year_month_small,
)
