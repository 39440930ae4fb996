"""Writers: JSON lines, explicit-schema bronze Parquet, the date-partitioned
archive, layer tables, and the topic sink contract."""
