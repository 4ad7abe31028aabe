"""Star roles and documents over the TPC-H-like test tables, and their DuckDB twins."""
