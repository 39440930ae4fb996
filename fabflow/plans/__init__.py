"""Medallion layers (bronze, silver, gold) and the registered query catalogue
with its DuckDB oracle SQL."""
