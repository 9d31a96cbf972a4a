"""Incremental edge building over a growing ledger folder (Structured Streaming).

The batch pipeline appends each run's daily edges to one table ("create if missing, then
insert").  Here a file-source stream picks up new ledger files, every micro-batch runs the
same batch operators on just those rows, and ``foreachBatch`` appends the edges keyed by
(day, transaction): a day may arrive in any number of micro-batches and keeps the edges of
all of them, while a replayed micro-batch (after a failure) adds nothing.  The stream's
checkpoint lives in the shared checkpoint folder, so a restarted driver resumes where it
stopped.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

from hopweave.operators import graph as g
from hopweave.session import checkpoint_dir


def first_hop_edges(batch: DataFrame, seeds: DataFrame, min_wei=g.DUST_WEI) -> DataFrame:
    """Seed ↔ first-hop edges of one ledger slice, as daily edge rows."""
    return g.g_edge_features(g.g_e1_dust(g.g_first_hop(batch, seeds), min_wei))


def start_edge_stream(spark: SparkSession, ledger_dir: str, seeds: DataFrame, out_path: str,
                      name: str = "edges", available_now: bool = False, min_wei=g.DUST_WEI):
    """Start the stream; returns the ``StreamingQuery``."""
    schema = spark.read.parquet(ledger_dir).schema
    src = spark.readStream.schema(schema).parquet(ledger_dir)

    def write(batch: DataFrame, epoch_id: int) -> None:
        g.g_append_final(first_hop_edges(batch, seeds, min_wei), out_path)

    ckpt = os.path.join(checkpoint_dir(spark).rstrip("/"), "streams", name)
    w = src.writeStream.foreachBatch(write).option("checkpointLocation", ckpt)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()
