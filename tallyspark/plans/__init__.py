"""Registered queries with their SQL counterparts."""

from . import (  # noqa: F401
    click_queries,
    format_queries,
    graph_queries,
    ml_queries,
    physical_queries,
    random_queries,
    rating_queries,
    season_queries,
    telecom_queries,
)
from .registry import ORACLES, QUERIES  # noqa: F401
