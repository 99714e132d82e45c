"""What streams report about each batch, as rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQueryListener

ROW = (
    "query string, run string, batch long, started string, input_rows long, input_rate double, processed_rate double, "
    "state_rows long, updated_rows long, dropped_rows long, watermark string"
)


def progress_row(progress) -> tuple:
    """One row for a batch. ``dropped_rows`` are rows that came to a stateful operator behind the watermark: for counts, groups
    of reports that a task had already counted together, not single reports."""
    states = progress.stateOperators
    return (
        progress.name, str(progress.runId), progress.batchId, progress.timestamp, progress.numInputRows,
        float(progress.inputRowsPerSecond or 0.0), float(progress.processedRowsPerSecond or 0.0), sum(state.numRowsTotal for state in states),
        sum(state.numRowsUpdated for state in states), sum(state.numRowsDroppedByWatermark for state in states), progress.eventTime.get("watermark"),
    )


class ProgressLog(StreamingQueryListener):
    """Collects a row for each batch of the session's streams, or of those named ``name``.

    With a ``path`` the rows are appended there whenever ``every`` have come and when a query ends, so the
    driver holds no more than these.
    """

    def __init__(self, spark: SparkSession, name: str | None = None, path: str | None = None, every: int = 100):
        self.spark, self.name, self.path, self.every = spark, name, path, every
        self.found: list[tuple] = []

    def __enter__(self) -> ProgressLog:
        self.spark.streams.addListener(self)
        return self

    def __exit__(self, *error) -> None:
        self.settle()
        self.spark.streams.removeListener(self)

    def settle(self) -> None:
        """Wait until all events that were sent are here."""
        self.spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        if self.name is None or progress.name == self.name:
            self.found.append(progress_row(progress))
            if self.path is not None and len(self.found) >= self.every:
                self.flush()

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        if self.path is not None:
            self.flush()

    def flush(self) -> None:
        rows, self.found = self.found, []
        if rows:
            self.spark.createDataFrame(rows, ROW).coalesce(1).write.mode("append").parquet(self.path)

    def rows(self) -> DataFrame:
        """All rows so far, written ones included."""
        self.settle()
        here = self.spark.createDataFrame(self.found, ROW)
        if self.path is None:
            return here
        self.flush()
        return self.spark.read.schema(ROW).parquet(self.path)
