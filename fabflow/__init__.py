"""fabflow: telemetry quality and analytics as lazy Spark DataFrame plans.

Every public function takes and returns DataFrames (or builds a streaming
query); nothing pulls data to the driver. Subpackages:

* ``sources``   readers (parquet archive, JSON lines, topic, bridge views)
* ``sinks``     writers (JSON lines, bronze parquet, date archive, topic)
* ``functions`` Column-level helpers (formatting, parsing, seeded draws)
* ``operators`` profiles, data-quality rules, process control, windows, dedup
* ``plans``     medallion pipeline and the registered query catalogue
* ``streaming`` Structured Streaming jobs (archive, dedup, KPIs, alerts)
"""

__version__ = "0.1.0"
