"""Run a load each time new stage files land in a folder.

The stage folder is read as a file stream (``readStream`` text source); every
micro-batch holds the lines of files not seen before, parsed with the same
Hive text rules as ``scan_stage``, and ``foreachBatch`` applies the load
pattern to the target table.  The stream's checkpoint remembers which files
were loaded, so each stage file is loaded once; with the ``availableNow``
trigger one call loads everything that has arrived and stops, which is how a
scheduled incremental load runs.

A batch that fails is retried from its start.  Each batch is applied once
whatever the pattern and wherever the run was cut (``plans.apply.Batch``):
its number is committed with the table version, or a replay finishes from
what the first attempt wrote down next to the stream checkpoint.

``max_files_per_batch`` bounds a micro-batch (``maxFilesPerTrigger``): a
backlog of stage files after downtime is loaded in several bounded batches,
also under ``availableNow``, instead of one batch of unbounded size.  When the
spec names a ``location`` for the rewritten table, each batch writes its
version to a fresh folder under it.

Batches run in a clone of the session, so a session that read the target
before must ``spark.catalog.refreshTable(target)`` to see the swapped table.
"""

from __future__ import annotations

import hashlib
import os
import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from loadwright.plans.apply import _DISCARDS_BASE, Batch, run_load
from loadwright.session import scratch_path
from loadwright.sources.stage import DEFAULT_SEPARATOR, NULL_TOKEN, parse_stage_lines

def start_stage_load(
    spark: SparkSession,
    stage_dir: str,
    schema: T.StructType,
    target: str,
    spec: Mapping,
    checkpoint_location: str | None = None,
    sep: str = DEFAULT_SEPARATOR,
    null_token: str = NULL_TOKEN,
    available_now: bool = True,
    processing_time: str | None = None,
    max_files_per_batch: int | None = None,
) -> StreamingQuery:
    """Start loading new files of ``stage_dir`` into ``target`` with ``spec``.

    ``checkpoint_location`` defaults to a fresh folder under the session's
    checkpoint folder; pass a fixed one to resume across runs.

    Patterns that replace the whole table (history, overwrite, full refresh)
    need all files in one batch, or each batch would discard the one before:
    with ``max_files_per_batch`` or ``processing_time`` they are refused.
    """
    if spec.get("pattern") in _DISCARDS_BASE and (max_files_per_batch or processing_time or not available_now):
        raise ValueError(f"pattern {spec['pattern']!r} replaces the table, so its files cannot load in several batches")
    ckpt = checkpoint_location or scratch_path(spark, "stage_stream")
    markers = os.path.join(ckpt, "applied_batches")
    reader = spark.readStream.format("text")
    if max_files_per_batch:
        reader = reader.option("maxFilesPerTrigger", int(max_files_per_batch))
    lines = reader.load(stage_dir)
    rows = parse_stage_lines(lines, schema, sep, null_token)
    stream = hashlib.sha256(f"{ckpt.rstrip('/')}\n{target}".encode()).hexdigest()[:16]

    def load_batch(batch: DataFrame, batch_id: int) -> None:
        mark = Batch(stream, batch_id, markers)
        if mark.noted(batch.sparkSession, "applied") is not None:
            return
        batch_spec = spec
        if spec.get("location"):
            fresh = f"batch-{batch_id}-{uuid.uuid4().hex[:8]}"
            batch_spec = dict(spec, location=os.path.join(spec["location"], fresh))
        run_load(target, batch, batch_spec, batch=mark)
        mark.applied(batch.sparkSession)

    writer = rows.writeStream.foreachBatch(load_batch).option("checkpointLocation", ckpt)
    if processing_time:
        writer = writer.trigger(processingTime=processing_time)
    elif available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()
