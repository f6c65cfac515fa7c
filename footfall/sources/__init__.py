"""Where events come from and where results go."""

from footfall.sources.adapters import events_as_clicks, orders_as_clicks
from footfall.sources.bucketed import write_bucketed
from footfall.sources.csv_events import map_columns, read_events_csv, to_raw_events
from footfall.sources.layers import (
    create_layers,
    drop_layers,
    query,
    reload_raw_events,
    replace_staging_view,
    replace_table,
)
from footfall.sources.snapshots import REPORTS, export_snapshots, load_report, snapshot_manifest
from footfall.sources.warehouse import LAYOUTS, Layout, arrange, read_layout, require_columns, write_layout

__all__ = [
    "LAYOUTS",
    "Layout",
    "REPORTS",
    "arrange",
    "create_layers",
    "drop_layers",
    "events_as_clicks",
    "export_snapshots",
    "load_report",
    "map_columns",
    "orders_as_clicks",
    "query",
    "read_events_csv",
    "reload_raw_events",
    "replace_staging_view",
    "replace_table",
    "read_layout",
    "require_columns",
    "snapshot_manifest",
    "to_raw_events",
    "write_bucketed",
    "write_layout",
]
