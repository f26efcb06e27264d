"""The daily run as a stream: only files not seen before are read, and their builds added to the store.

The store is a table of deltas, one per batch: a batch writes the rows it brings and nothing else, so a day costs what
the day delivers, however large the store is. Reading folds the deltas of a key together; ``compact`` does so once.

What is live is said by a manifest: the folder that holds the rows of all batches up to a number. Deltas above that number
count as well. A manifest is committed by one rename after everything it names is complete, and nothing is overwritten,
so a compaction that stops anywhere leaves the store as it was or as it will be. Folders without Spark's success mark,
or that no manifest needs, are not read; ``vacuum`` deletes them.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from driftlens.operators.merging import fold
from driftlens.runtime import Folder

BATCH = "batch"
DELTAS, FOLDED, MANIFESTS = "deltas", "folded", "manifests"


def live(spark: SparkSession, store: str) -> tuple[str | None, int, list[int]]:
    """The folder of folded rows (if any), the last batch in it (-1: none), and the complete batches after it."""
    folder = Folder(spark, store)
    known = sorted(int(name) for name in folder.names(MANIFESTS) if name.isdigit())
    held = json.loads(folder.text(f"{MANIFESTS}/{known[-1]}")) if known else {"folder": None, "upto": -1}
    batches = [int(name.removeprefix(f"{BATCH}=")) for name in folder.names(DELTAS) if name.startswith(f"{BATCH}=") and folder.complete(f"{DELTAS}/{name}")]
    return held["folder"], held["upto"], sorted(b for b in batches if b > held["upto"])


def read_deltas(spark: SparkSession, store: str) -> DataFrame | None:
    """All live rows with their batch number, or None where nothing is stored yet."""
    folded, _, batches = live(spark, store)
    parts = [spark.read.parquet(f"{store}/{FOLDED}/{folded}")] if folded else []
    parts += [spark.read.option("basePath", f"{store}/{DELTAS}").parquet(*[f"{store}/{DELTAS}/{BATCH}={b}" for b in batches]).withColumn(BATCH, F.col(BATCH).cast("long"))] if batches else []
    if not parts:
        return None
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1], allowMissingColumns=True)


def read_store(spark: SparkSession, store: str, key: str = "symbol_key") -> DataFrame | None:
    """One row per key: lists united, kept fields by their newest filled value, the rest by the newest batch."""
    deltas = read_deltas(spark, store)
    return None if deltas is None else fold(deltas, key, BATCH)


def compact(spark: SparkSession, store: str, key: str = "symbol_key") -> None:
    """Fold all live rows into a new folder and commit it. Batches may be merged meanwhile; two compactions may not."""
    deltas, (_, upto, batches) = read_deltas(spark, store), live(spark, store)
    if deltas is None or not batches:
        return
    newest, name = batches[-1], uuid.uuid4().hex
    fold(deltas.filter(F.col(BATCH) <= newest), key, BATCH).withColumn(BATCH, F.lit(newest).cast("long")).write.parquet(f"{store}/{FOLDED}/{name}")
    Folder(spark, store).publish(f"{MANIFESTS}/{newest}", json.dumps({"folder": name, "upto": newest}))


def vacuum(spark: SparkSession, store: str) -> None:
    """Delete what is not live. Run it while nobody reads an earlier state."""
    folder = Folder(spark, store)
    folded, upto, _ = live(spark, store)
    gone = [f"{FOLDED}/{name}" for name in folder.names(FOLDED) if name != folded]
    gone += [f"{DELTAS}/{name}" for name in folder.names(DELTAS) if name.startswith(f"{BATCH}=") and int(name.removeprefix(f"{BATCH}=")) <= upto]
    gone += [f"{MANIFESTS}/{name}" for name in folder.names(MANIFESTS) if not name.isdigit() or int(name) < upto]
    for path in gone:
        folder.delete(path)


def merge_available(arrivals: DataFrame, store: str, checkpoint: str, key: str = "symbol_key", order: str = "ord",
                    prepare: Callable[[DataFrame], DataFrame] | None = None) -> None:
    """Merge everything ``arrivals`` has not delivered before, then stop.

    Batch n writes delta n alone, so a batch that is run again after a failure gives the same store.
    """

    def merge(batch: DataFrame, batch_id: int) -> None:
        incoming = fold(prepare(batch) if prepare else batch, key, order)
        incoming.write.mode("overwrite").parquet(f"{store}/{DELTAS}/{BATCH}={batch_id}")

    query = (arrivals.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start())
    query.awaitTermination()
