"""Person fact for persons arriving over time (Structured Streaming).

New cohort rows (for example, daily files of newly positive persons) are read
as a stream. Each micro-batch is a bounded set of persons; ``foreachBatch``
runs the same batch operators on it against the static event tables and
writes the batch's rows to ``<out>/batch_id=<n>``. A replayed batch
overwrites its own folder, so the sink is exactly-once with the checkpoint.

No streaming state is kept: every step of the person fact is per person,
and the event tables are read whole for each batch's persons.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from ..plans.person_fact import person_fact_stages
from ..session import checkpoint_dir
from ..sources import AnyInputs
from ..sources.sinks import write_stage


def person_fact_stream(
    cohort_stream: DataFrame,
    inputs: AnyInputs,
    out_path: str,
    checkpoint_location: str | None = None,
    available_now: bool = True,
) -> StreamingQuery:
    """Start the stream; returns the running query.

    ``checkpoint_location`` defaults to ``<spark.checkpoint.dir>/person_fact_stream``.
    ``available_now`` processes what is there and stops; otherwise it runs
    until stopped.
    """
    if checkpoint_location is None:
        root = checkpoint_dir(inputs.spark)
        if not root:
            raise ValueError("set spark.checkpoint.dir or pass checkpoint_location")
        checkpoint_location = f"{root.rstrip('/')}/person_fact_stream"

    def run_batch(batch: DataFrame, batch_id: int) -> None:
        fact = person_fact_stages(inputs, cohort=batch).fact
        write_stage(fact, f"{out_path.rstrip('/')}/batch_id={batch_id}")

    writer = cohort_stream.writeStream.foreachBatch(run_batch).option("checkpointLocation", checkpoint_location)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
