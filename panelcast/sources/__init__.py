"""Scans and sinks: fixture views over the supplied tables, CSV/Parquet reads, writes."""

from panelcast.sources.tables import read_table, sales_df, taxonomy_df, stores_df, joined_sales
from panelcast.sources.files import read_csv, read_input
from panelcast.sources.sinks import write_predictions, append_results, read_results

__all__ = ["read_table", "sales_df", "taxonomy_df", "stores_df", "joined_sales",
           "read_csv", "read_input", "write_predictions", "append_results", "read_results"]
