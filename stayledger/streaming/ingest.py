"""The scheduled normal run as a Structured Streaming query.

The original job is run on a schedule over newly landed booking files. Here
a file stream over the landing folder does the bookkeeping of which files
are new (in its checkpoint), and each micro-batch goes through the same
steps as a normal run: transform, value checks, commit. With
``availableNow`` every start processes what has landed since the last one
and stops, which is the scheduled run. No cap splits that into several
micro-batches: the value checks see all of a start's rows together, as in a
normal run.

A stream needs a declared schema (no inference pass); the structure check
is therefore the declaration itself, and a record that does not fit it fails
the batch. ``foreachBatch`` is at-least-once: after
a restart the last micro-batch may be handed over again. Each commit records
the stream (its checkpoint location) and the micro-batch id as its ``txn``,
and a batch whose ``txn`` is the table's latest commit is skipped, so every
micro-batch is committed exactly once (one writer per table).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..operators import table as TB
from ..plans.normal_run import RunConfig, run_on_raw
from ..sources.bookings import refuse_corrupt, with_corrupt_record


def batch_txn(checkpoint_location: str, batch_id: int) -> str:
    """Name of a micro-batch's commit: stable across restarts of the stream."""
    return f"{checkpoint_location.rstrip('/')}#{batch_id}"


def batch_committer(spec: TB.TableSpec, cfg: RunConfig,
                    checkpoint_location: str) -> Callable[[DataFrame, int], None]:
    """The ``foreachBatch`` function: transform, check and commit a micro-batch
    once, under its ``batch_txn``."""
    def commit_batch(batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():
            return
        run_on_raw(batch.sparkSession, batch, spec, cfg, check_schema=False,
                   txn=batch_txn(checkpoint_location, batch_id))
    return commit_batch


def start_ingest(spark: SparkSession, landing_dir: str, schema: T.StructType | str,
                 spec: TB.TableSpec, cfg: RunConfig, checkpoint_location: str,
                 available_now: bool = True) -> StreamingQuery:
    """Start the stream; returns the running query (``awaitTermination`` it)."""
    stream = refuse_corrupt(spark.readStream.schema(with_corrupt_record(schema)).json(landing_dir))
    writer = (stream.writeStream.foreachBatch(batch_committer(spec, cfg, checkpoint_location))
              .option("checkpointLocation", checkpoint_location)
              .queryName(f"ingest-{spec.path.rsplit('/', 1)[-1]}"))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()


def run_ingest_once(spark: SparkSession, landing_dir: str, schema: T.StructType | str,
                    spec: TB.TableSpec, cfg: RunConfig, checkpoint_location: str) -> None:
    """Process everything landed since the last run, then return."""
    q = start_ingest(spark, landing_dir, schema, spec, cfg, checkpoint_location)
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
