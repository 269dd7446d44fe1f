from .tables import (  # noqa: F401
    CONTRACT, read_table, scan_transactions, align_schema, tx_events,
    tx_vectors, tx_lines, scored, feature_columns, v_columns,
)
