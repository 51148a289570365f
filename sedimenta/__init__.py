"""Change-data-capture analytics over versioned Parquet tables, on Spark."""
