"""Sources: text lines, delimited text, JSON, parquet directories, JDBC, generated ranges."""
