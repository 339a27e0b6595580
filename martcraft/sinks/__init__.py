"""Write modes (SNK1-SNK13) over date-partitioned parquet tables."""
