"""Readers and writers."""
from .readers import (  # noqa: F401
    read_events, read_ip_locations, read_json_lines, read_products, read_raw_events, read_seed,
)
from .writers import (  # noqa: F401
    append_table, replace_table, write_clustered, write_csv, write_json_lines, write_partitioned,
    write_snapshot,
)
