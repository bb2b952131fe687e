"""Readers for landed raw documents, CSV extracts and small config tables."""

from .schemas import FLAT_ITEM_SCHEMA, NESTED_VARIABLE_SCHEMA  # noqa: F401
from .readers import (  # noqa: F401
    read_flat_series, read_nested, read_csv_typed, read_csv_strings,
    read_with_file_name,
)
from .snapshots import newest_snapshots, select_datasets  # noqa: F401
from .catalog import (  # noqa: F401
    INDICATORS, SERIES, STATES, date_range, indicator_catalog,
    series_catalog, state_dimension, window_table,
)
