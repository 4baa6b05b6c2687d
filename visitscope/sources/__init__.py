"""Action, profile and task tables: catalog tables, DataFrames, test views, JDBC."""

from .tables import (
    CatalogSource,
    FrameSource,
    filter_date_range,
    normalize_actions,
    register_views,
)
from .testdata import GeneratedSource, actions_from_events

__all__ = [
    "CatalogSource", "FrameSource", "GeneratedSource", "actions_from_events",
    "filter_date_range", "normalize_actions", "register_views",
]
