"""Where rows come from: SQLite files, and Parquet tables or DataFrames."""
