"""Reading and writing: CSV, Parquet, and the shared scratch folder."""
