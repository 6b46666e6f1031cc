"""Progress of streaming queries, kept in a table.

Spark holds the last hundred progress reports of a query in memory; the
listener here writes a row per finished micro-batch to a table, so a run of any
length can be reported afterwards, also by another session.
"""

from __future__ import annotations

import json
import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

PROGRESS_SCHEMA = (
    "query_id string, run_id string, query_name string, batch_id bigint, batch_time timestamp, num_input_rows bigint, "
    "input_rows_per_second double, processed_rows_per_second double, trigger_ms bigint, state_rows bigint, "
    "observed map<string, map<string, double>>"
)


def progress_row(p) -> dict:
    """One row of the table from a progress report."""
    d = json.loads(p.json)
    numbers = lambda values: {k: float(v) for k, v in values.items() if isinstance(v, (int, float))}
    return {
        "query_id": d["id"],
        "run_id": d["runId"],
        "query_name": d.get("name"),
        "batch_id": int(d["batchId"]),
        "batch_time": d["timestamp"],
        "num_input_rows": int(d["numInputRows"]),
        "input_rows_per_second": float(d.get("inputRowsPerSecond") or 0.0),
        "processed_rows_per_second": float(d.get("processedRowsPerSecond") or 0.0),
        "trigger_ms": int((d.get("durationMs") or {}).get("triggerExecution", 0)),
        "state_rows": int(sum(op.get("numRowsTotal", 0) for op in d.get("stateOperators") or [])),
        "observed": {k: numbers(v) for k, v in (d.get("observedMetrics") or {}).items()},
    }


class ProgressLog(StreamingQueryListener):
    """Appends a row per finished micro-batch of every query of the session to
    the JSON table at ``path``.

    Reports that arrive while a write is under way go into the next write, so
    short batches do not queue up.  Reports of triggers without a batch are not
    kept.  :meth:`wait` returns when all reports of a finished query are in the
    table; :meth:`stop` ends the log.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self._rows: list[dict] = []
        self._ended: set[str] = set()
        self._written: set[str] = set()
        self._failed: BaseException | None = None
        self._stopped = False
        self._change = threading.Condition()
        self._writer = threading.Thread(target=self._write, daemon=True)
        self._writer.start()
        spark.streams.addListener(self)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        if "addBatch" in p.durationMs:  # else no batch was run
            with self._change:
                self._rows.append(progress_row(p))
                self._change.notify_all()

    def onQueryTerminated(self, event) -> None:
        with self._change:
            self._ended.add(str(event.runId))
            self._change.notify_all()

    def _write(self) -> None:
        while True:
            with self._change:
                self._change.wait_for(lambda: self._rows or self._ended - self._written or self._stopped)
                rows, ended = self._rows, set(self._ended)
                self._rows = []
                if not rows and not ended - self._written:
                    return
            try:
                if rows:
                    lines = self.spark.createDataFrame([(json.dumps(r),) for r in rows], "value string")
                    lines.coalesce(1).write.mode("append").text(self.path)
            except BaseException as e:  # noqa: BLE001 - kept for wait(), which raises it
                with self._change:
                    self._failed = e
            with self._change:
                self._written |= ended
                self._change.notify_all()

    def wait(self, query: StreamingQuery, timeout: float = 120.0) -> None:
        """Until the reports of ``query``, which has ended, are in the table."""
        with self._change:
            if not self._change.wait_for(lambda: str(query.runId) in self._written, timeout):
                raise TimeoutError(f"no end of query {query.runId} within {timeout} s")
            if self._failed:
                raise RuntimeError("progress rows could not be written") from self._failed

    def stop(self) -> None:
        self.spark.streams.removeListener(self)
        with self._change:
            self._stopped = True
            self._change.notify_all()
        self._writer.join()


def read_progress(spark: SparkSession, path: str) -> DataFrame:
    """The progress table.  A batch that was run again has its last report."""
    rows = spark.read.schema(PROGRESS_SCHEMA).json(path)
    names = [c for c in rows.columns if c not in ("query_id", "batch_id")]
    last = rows.groupBy("query_id", "batch_id").agg(F.max_by(F.struct(*names), F.struct("batch_time", "run_id")).alias("r"))
    return last.select("query_id", "batch_id", "r.*").select(rows.columns)
