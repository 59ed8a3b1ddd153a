"""Writers: table loads, database export, multi-table copy."""
