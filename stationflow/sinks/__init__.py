"""Writers: Parquet / CSV / JSON-lines files and catalog tables."""
