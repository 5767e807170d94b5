"""Table contracts, CSV and Parquet input and output, and the order-data mapping."""
