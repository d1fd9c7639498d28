"""Rounds driven by Structured Streaming."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from cdclake.plans import replicate as rp
from cdclake.sources import storage
from cdclake.sources.local import no_rows
from cdclake.streaming.descriptors import read_descriptors


class RoundLog(StreamingQueryListener):
    """Progress reports and errors of streams.

    With a folder, every event is appended there as a file, and nothing is dropped. The newest
    ``keep`` are also at hand in ``reports`` and ``errors``.
    """

    def __init__(self, keep: int = 100, spark: SparkSession | None = None, folder: str | None = None):
        self.keep, self.reports, self.errors, self.spark, self.folder = keep, [], [], spark, folder

    def _append(self, kind: str, row: dict) -> None:
        if self.folder:
            storage.write_text(self.spark, f"{self.folder}/{kind}-{uuid.uuid4().hex}.json", json.dumps(row) + "\n")

    def onQueryStarted(self, event):
        pass

    def onQueryProgress(self, event):
        p = event.progress
        row = {"batch": p.batchId, "descriptors": p.numInputRows, "ms": p.batchDuration}
        self.reports = [*self.reports, row][-self.keep:]
        self._append("report", {"at": p.timestamp, **row})

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        if event.exception:
            self.errors = [*self.errors, event.exception][-self.keep:]
            self._append("error", {"error": event.exception})


_attached: dict[tuple[int, str], RoundLog] = {}


def stream_log(spark: SparkSession, settings: rp.Settings) -> DataFrame:
    """All reports and errors of the streams that ran into a target: (at, batch, descriptors, ms, error)."""
    schema = "at string, batch bigint, descriptors bigint, ms bigint, error string"
    folder = f"{settings.target}/_rounds/stream"
    return spark.read.schema(schema).json(storage.literal(folder) + "/*.json") if storage.list_names(spark, folder) else no_rows(spark, schema)


#: Stores that the planning of descriptors can list: paths without a scheme, and these.
LISTED = ("file", "s3", "s3a", "s3n", "hdfs")


def _pending(spark: SparkSession, settings: rp.Settings) -> DataFrame:
    """What starts rounds: descriptors of new files where they can be listed, else one row per trigger."""
    scheme, colon, _ = settings.source.partition(":")
    if not colon or scheme in LISTED:
        return read_descriptors(spark, settings.source, settings.tables)
    return spark.readStream.format("rate-micro-batch").options(rowsPerBatch=1, numPartitions=1).load()


def start_rounds(
    spark, settings: rp.Settings, checkpoint_location: str, every: str | None = "1 minute", on_round=None,
) -> StreamingQuery:
    """Run a round whenever a newer checkpoint is published.

    ``every=None`` works off what is there and stops. Each micro-batch is one
    round against the committed cursors: files of a batch that is replayed
    after a crash, but was committed, are behind the cursors and do nothing, so
    a result may load fewer files than its batch announced.

    Descriptors are planned outside the JVM, where only some stores are known. On all others
    that Hadoop knows a clock starts the batches, and the round alone looks for what is new,
    through the session's file systems.
    """

    def one_round(batch: DataFrame, batch_id: int) -> None:
        announced = 0 if "db" not in batch.columns else batch.where("db is not null").agg(F.sum(F.expr("end_idx - start_idx + 1"))).first()[0] or 0
        result, _ = rp.apply_round(batch.sparkSession, settings)
        result.announced_files = announced
        if on_round is not None:
            on_round(result)

    place = (id(spark), f"{settings.target}/_rounds/stream")
    if place not in _attached:
        _attached[place] = RoundLog(spark=spark, folder=place[1])
        spark.streams.addListener(_attached[place])
    writer = _pending(spark, settings).writeStream.foreachBatch(one_round).option("checkpointLocation", checkpoint_location)
    writer = writer.trigger(availableNow=True) if every is None else writer.trigger(processingTime=every)
    return writer.start()
