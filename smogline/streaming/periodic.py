"""The periodic monitoring step driven by a stream of batch arrivals.

Each arriving file names one batch; ``foreachBatch`` runs
``plans.flows.periodic_step`` for the batches of the micro-batch in order.
Because the step replaces its rows by key and by range, a replayed
micro-batch leaves the same tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

ARRIVAL_SCHEMA = "batch long"


def stream_periodic(
    spark: SparkSession, arrivals_dir: str, checkpoint: str, step: Callable[[int], dict]
) -> list[dict]:
    """Process every arrival file available now, one file per micro-batch."""
    results: list[dict] = []

    def run(batch_df: DataFrame, epoch_id: int) -> None:
        # a micro-batch holds at most a few batch numbers (one per file)
        for r in sorted(batch_df.select("batch").distinct().collect()):
            results.append(step(int(r["batch"])))

    q = (
        spark.readStream.schema(ARRIVAL_SCHEMA)
        .option("maxFilesPerTrigger", 1)
        .json(arrivals_dir)
        .writeStream.foreachBatch(run)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination()
    return results
