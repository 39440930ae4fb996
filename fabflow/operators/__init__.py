"""DataFrame -> DataFrame operators.

quality (rule engine, reports, gate), profile (column profiles), quantiles
(exact quantiles in bounded memory), filters, sorting (limits, samples, set
operations), dedup, merge (Parquet upsert), joins (size-checked broadcast),
spc (process control, normality tests), windows (bucketed rolling windows).
"""
