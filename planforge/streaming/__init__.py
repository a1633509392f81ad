"""Documents prepared as they arrive."""

from __future__ import annotations

import hashlib

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..plans.drivers import prepare_documents
from ..sources.store import Store


def prepare_stream(spark: SparkSession, store: Store, incoming: str, checkpoint: str) -> StreamingQuery:
    """Documents (JSON lines of source_path, md, middle) become extractions, once each while the checkpoint stays.

    A batch that is run again after a failure, wherever it was lost, replaces what it had written or, once it was marked,
    adds nothing: the store appends a batch of one name once.
    """
    docs = spark.readStream.schema("source_path string, md string, middle string").json(incoming)
    name = hashlib.sha1(checkpoint.encode()).hexdigest()[:16]

    def append(batch, number: int) -> None:
        store.append_extractions(prepare_documents(batch), f"stream-{name}-{number}")

    return docs.writeStream.foreachBatch(append).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
