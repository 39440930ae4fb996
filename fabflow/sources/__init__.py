"""Readers: Parquet archives with file identity, JSON lines in both timestamp
encodings with quarantine, the topic source contract, and the telemetry views
over the test tables."""
