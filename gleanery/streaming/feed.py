"""Requests that arrive as a stream, each answered once against static tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from gleanery.plans.engine import Engine
from gleanery.plans.requests import run_requests
from gleanery.session import Scope, materialise


def once_only(requests: DataFrame, arrival: str | None = None, delay: str = "1 day") -> DataFrame:
    """A stream without its repeated requests, which the state store remembers.

    A request repeats another one if all its columns but ``arrival`` are equal, as when a
    client or a queue sends it again.  With the time of ``arrival`` a request is remembered
    for ``delay`` only, and the state is bounded; without it every request is.
    """
    content = [c for c in requests.columns if c != arrival]
    if arrival is None:
        return requests.dropDuplicates(content)
    return requests.withWatermark(arrival, delay).dropDuplicatesWithinWatermark(content)


def answer_stream(
    requests: DataFrame,
    engines: dict[str, Engine],
    output: str,
    checkpoint: str,
    trigger: dict | None = None,
    arrival: str | None = None,
    delay: str = "1 day",
) -> StreamingQuery:
    """Answer each micro-batch with the batch job and write what it gives.

    Ranking is no streaming operation, so every micro-batch runs as a batch.  It
    replaces its own ``batch=<id>`` folders and enters itself in the manifest last: a
    micro-batch that is repeated after a failure leaves its answers there once, and
    ``read_answers`` sees finished ones only.  A request that was sent again is not
    answered again, see ``once_only``.

    A micro-batch is written down and read from there by all steps; when it is answered,
    everything but the answers is deleted.
    """

    def answer(batch: DataFrame, batch_id: int) -> None:
        with Scope():
            asked = materialise(batch.drop(arrival) if arrival else batch, "micro-batch")
            results, rejects = run_requests(asked, engines)
            results.write.mode("overwrite").parquet(f"{output}/results/batch={batch_id}")
            rejects.write.mode("overwrite").parquet(f"{output}/rejects/batch={batch_id}")
            done = asked.agg(F.count("*").alias("n_requests"))
            done.write.mode("overwrite").parquet(f"{output}/manifest/batch={batch_id}")

    return (
        once_only(requests, arrival, delay)
        .writeStream.foreachBatch(answer)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def read_answers(spark: SparkSession, output: str, what: str = "results") -> DataFrame:
    """The ``results`` or ``rejects`` of all finished micro-batches."""
    finished = spark.read.parquet(f"{output}/manifest").select("batch")
    return spark.read.parquet(f"{output}/{what}").join(F.broadcast(finished), "batch", "left_semi").drop("batch")
