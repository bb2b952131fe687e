"""DataFrame operators (flatten, reshape, aggregate, window, join, contract, publish)."""

from . import aggregates, contracts, flatten, joins, publish, reshape, windows  # noqa: F401
