"""Readers, writers and dimension tables."""
from .corpora import (
    combine_corpora,
    distinct_values,
    one_per_first_turn,
    one_per_key,
    read_corpus,
    read_lines,
    read_locations,
    row_count,
    rows_not_in,
    shared_columns,
)
from .dimensions import CONTINENT_OVERRIDES, with_continent
from .sinks import write_csv, write_parquet, write_partitions

__all__ = [
    "CONTINENT_OVERRIDES", "combine_corpora", "distinct_values", "one_per_first_turn",
    "one_per_key", "read_corpus", "read_lines", "read_locations", "row_count",
    "rows_not_in", "shared_columns", "with_continent", "write_csv",
    "write_parquet", "write_partitions",
]
