"""Structured Streaming jobs: archive, JSON append, watermark dedup, windowed
KPIs, per-batch quality gate, and out-of-limit run alerts."""
