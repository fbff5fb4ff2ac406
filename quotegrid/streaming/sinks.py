"""Where live messages go. A batch that a restarted stream runs again is not sent again.

A sink is a function of messages (``symbol``, ``timestamp``, ``value``) and batch number. After it returned, the
number is recorded in a log of fixed size, and a recorded batch is skipped. A stream that dies between sending and recording sends
one batch twice: a folder's batch is then replaced, and a topic's messages carry the same key again.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Sink = Callable[[DataFrame, int], None]
SLOTS = 64  # files of the log; a stream only ever repeats its newest batch


class CommitLog:
    """The batches that were sent, below a folder that belongs to one stream."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root

    def _slot(self, batch_id: int) -> str:
        return f"{self.root}/slot={batch_id % SLOTS}"

    def has(self, batch_id: int) -> bool:
        try:
            rows = self.spark.read.schema("batch_id bigint, messages bigint").parquet(self._slot(batch_id))
            return not rows.where(F.col("batch_id") == batch_id).isEmpty()
        except AnalysisException:
            return False

    def record(self, batch_id: int, messages: int) -> None:
        row = self.spark.createDataFrame([(batch_id, messages)], "batch_id bigint, messages bigint")
        row.coalesce(1).write.mode("overwrite").parquet(self._slot(batch_id))


def sent_once(sink: Sink, log: CommitLog) -> Sink:
    """The sink for batches that the log does not have."""

    def send(messages: DataFrame, batch_id: int) -> None:
        if log.has(batch_id):
            # the state behind the messages moves on only if they are computed
            messages.write.format("noop").mode("overwrite").save()
            return
        messages.persist()  # counted and sent
        try:
            n = messages.count()
            if n:
                sink(messages, batch_id)
            log.record(batch_id, n)
        finally:
            messages.unpersist()

    return send


def folder_sink(path: str) -> Sink:
    """Text files, a folder for each batch, which is replaced as a whole."""

    def send(messages: DataFrame, batch_id: int) -> None:
        messages.select("value").write.mode("overwrite").text(f"{path}/batch={batch_id}")

    return send


def topic_rows(messages: DataFrame) -> DataFrame:
    """Messages as rows of a topic; the key names symbol and instant, so that receivers can tell repeats."""
    return messages.select(F.concat_ws("/", "symbol", F.col("timestamp").cast("string")).alias("key"), "value")


def topic_sink(servers: str, topic: str, **options: str) -> Sink:
    """Messages of a Kafka topic."""

    def send(messages: DataFrame, batch_id: int) -> None:
        writer = topic_rows(messages).write.format("kafka").options(**options)
        writer.option("kafka.bootstrap.servers", servers).option("topic", topic).save()

    return send
