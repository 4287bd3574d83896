"""Reading and writing: message topics, Parquet tables, JDBC tables, staged tables."""
