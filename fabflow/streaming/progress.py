"""Counters of a running query (STR-7, AGG-22, AGG-24): observed in the plan, reported by progress events.

The counters are aggregates that Spark computes while the rows pass
(``observe``), so they cost no second read. A batch job reads them from an
``Observation``; a stream posts them with every micro-batch, and
:class:`ProgressListener` adds them up, logs every so many batches and keeps a
bounded number of recent ones.
"""

from __future__ import annotations

import json
import logging
import threading
from collections import deque

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from fabflow import constants as C
from fabflow.sources.files import CORRUPT

log = logging.getLogger(__name__)

#: Name under which the streams of this package observe their input.
DELIVERY = "delivery"
PROGRESS = ("query string, batch_id bigint, input_rows bigint, sent bigint, failed bigint, anomalies bigint, "
            "unknown_equipment bigint, dropped_late bigint, rows_per_second double, seconds double")


def delivery_counters() -> list:
    """sent, failed, anomalies and unknown chambers over parsed wire rows."""
    good = F.col(CORRUPT).isNull() & F.col("timestamp").isNotNull()
    return [F.count_if(good).alias("sent"), F.count_if(~good).alias("failed"),
            F.count_if(good & F.col("is_anomaly")).alias("anomalies"),
            F.count_if(good & ~F.col("equipment_id").isin(C.VALID_EQUIPMENT)).alias("unknown_equipment")]


def observed(parsed: DataFrame) -> tuple[DataFrame, Observation]:
    """A batch of parsed rows whose counters are in the Observation once any action has read all of it."""
    seen = Observation(DELIVERY)
    return parsed.observe(seen, *delivery_counters()), seen


class ProgressListener(StreamingQueryListener):
    """Adds up the progress of every query of the session.

    ``totals(query)`` are exact over any number of batches; ``batches(spark)``
    lists the newest ``keep`` of them. A batch is counted once, when it is
    complete, however often it was tried. Every ``log_every`` batches the
    totals are logged.
    """

    def __init__(self, log_every: int = 100, keep: int = 10_000):
        self.log_every = log_every
        self.recent: deque[tuple] = deque(maxlen=keep)
        self.sums: dict[str, dict] = {}
        self.ended: dict[str, threading.Event] = {}
        self.lock = threading.Lock()

    def onQueryStarted(self, event) -> None:
        with self.lock:
            self.ended[str(event.id)] = threading.Event()

    def onQueryProgress(self, event) -> None:
        p = event.progress
        query = str(p.id)
        seen = p.observedMetrics.get(DELIVERY)
        counts = {c: int(seen[c] or 0) if seen else 0 for c in ("sent", "failed", "anomalies", "unknown_equipment")}
        dropped = sum(s.numRowsDroppedByWatermark for s in p.stateOperators)
        seconds = (p.durationMs or {}).get("triggerExecution", 0) / 1000
        with self.lock:
            total = self.sums.setdefault(query, {"batches": 0, "input_rows": 0, "dropped_late": 0, "seconds": 0.0, "last": -1,
                                                 **dict.fromkeys(counts, 0)})
            if p.batchId <= total["last"] and not p.numInputRows:
                return                                             # an idle trigger repeats the last batch's number
            total["last"] = p.batchId
            total["batches"] += 1
            total["input_rows"] += p.numInputRows
            total["dropped_late"] += dropped
            total["seconds"] += seconds
            for c, n in counts.items():
                total[c] += n
            self.recent.append((query, p.batchId, p.numInputRows, *counts.values(), dropped, float(p.processedRowsPerSecond or 0), seconds))
            if total["batches"] % self.log_every == 0:
                log.info("stream %s: %s", query, json.dumps(self._shown(total)))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        with self.lock:
            self.ended.setdefault(str(event.id), threading.Event()).set()

    def wait(self, query, timeout: float = 60) -> bool:
        """Whether the query's last event has arrived (events come after the query itself has ended)."""
        return self.ended.setdefault(str(query.id), threading.Event()).wait(timeout)

    @staticmethod
    def _shown(total: dict) -> dict:
        rows, tried = total["sent"], total["sent"] + total["failed"]
        return {**{k: v for k, v in total.items() if k != "last"}, "success_rate": rows / tried * 100.0 if tried else 0.0,
                "rows_per_second": tried / total["seconds"] if total["seconds"] else 0.0}

    def totals(self, query) -> dict:
        """Batches, rows, sent, failed, success rate, late rows dropped and rows per second of one query so far."""
        with self.lock:
            return self._shown(self.sums[str(query.id)])

    def batches(self, spark: SparkSession) -> DataFrame:
        """The newest batches of all queries, one row each."""
        with self.lock:
            return spark.createDataFrame(list(self.recent), PROGRESS)
