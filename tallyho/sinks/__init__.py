"""Writers: measurement text, summary parquet, formatted text lines."""
