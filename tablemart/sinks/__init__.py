"""Writers: Parquet tables, immutable snapshots, exports and run records."""
