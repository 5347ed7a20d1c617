"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path

BLOCK = 4 << 20  # bytes of text worked on at once; a longer text is a block of its own



def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Batches of 4 MB at most between Spark and Python workers, from now on in this session.

    Spark's own bound is 64 MB, which an executor holds several times for each running task.
    """
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BLOCK))


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    The lineage ends there (lost executors cost nothing that was written), and the planner
    knows the size of the table: small ones are broadcast by its own threshold, large ones
    are not.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def without(df: DataFrame, *names: str) -> DataFrame:
    """``df`` without the columns that an operator is about to add (case does not count)."""
    taken = {n.lower() for n in names}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in taken])


def in_training(doc_id: str = "doc_id"):
    """Rows that may be learned from: crc32 of the id as text, modulo 5, is not 0."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 != 0


def held_out(doc_id: str = "doc_id"):
    """The other rows; a null id is never learned from, so it counts as held out."""
    return F.coalesce(~in_training(doc_id), F.lit(True))


def add_columns(batch: pa.RecordBatch, columns: dict[str, pa.Array]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([*batch.columns, *columns.values()], names=[*batch.schema.names, *columns])


def blocks(batch: pa.RecordBatch, column: str, size: int = BLOCK) -> Iterator[pa.RecordBatch]:
    """Parts of a batch whose texts have about ``size`` bytes each."""
    lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    start, total = 0, 0
    for i, n in enumerate(lengths.tolist()):
        if total and total + n > size:
            yield batch.slice(start, i - start)
            start, total = i, 0
        total += n
    if start < batch.num_rows:
        yield batch.slice(start)


def text_blocks(batches: Iterable[pa.RecordBatch], column: str, size: int = BLOCK) -> Iterator[pa.RecordBatch]:
    """``blocks`` of all batches of a task; what the memory pool holds back is given up at the end."""
    for batch in batches:
        yield from blocks(batch, column, size)
    pa.default_memory_pool().release_unused()


def whole_groups(batches: Iterable[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Tables that end where a group ends, from batches in which equal keys are neighbours.

    Only the last, unfinished group is held back, so memory follows the largest group;
    callers cut large groups into blocks before.
    """
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column(key).to_numpy(zero_copy_only=False)
        if held and keys[0] != last:
            yield pa.Table.from_batches(held)
            held = []
        changes = np.flatnonzero(keys[1:] != keys[:-1])
        if changes.size:
            cut = int(changes[-1]) + 1
            yield pa.Table.from_batches([*held, batch.slice(0, cut)])
            held = [batch.slice(cut)]
        else:
            held.append(batch)
        last = keys[-1]
    if held:
        yield pa.Table.from_batches(held)


def in_blocks(rows: DataFrame, key: str, spread: str, block: int, name: str) -> DataFrame:
    """Cut the groups of ``key`` into cells that hold two blocks of about ``block`` rows at most.

    Adds ``__cell`` (a long) and ``__part`` (the block of the row, -1 in a cell of one
    block). Every two rows of a group meet in exactly one cell: rows of one block in the
    block's own cell, where all pairs count, rows of two blocks in the cell of the two,
    where only pairs with different ``__part`` count. ``spread`` deals rows to blocks.
    """
    large = stored(rows.groupBy(key).count().where(F.col("count") > block)
                   .select(key, F.ceil(F.col("count") / block).cast("int").alias("__blocks")), name)
    own = F.pmod(F.xxhash64(F.lit("block"), spread), F.col("__blocks")).cast("int")
    cells = F.when(F.col("__blocks").isNull(), F.array(F.struct(F.lit(0).alias("i"), F.lit(0).alias("j")))).otherwise(
        F.transform(F.sequence(F.lit(0), F.col("__blocks") - 1),
                    lambda j: F.struct(F.least(F.col("__own"), j).alias("i"), F.greatest(F.col("__own"), j).alias("j"))))
    out = rows.join(large, key, "left").withColumn("__own", own).withColumn("__c", F.explode(cells))
    return out.select(
        *rows.columns, F.xxhash64(key, "__c.i", "__c.j").alias("__cell"),
        F.when(F.col("__c.i") == F.col("__c.j"), F.lit(-1)).otherwise(F.col("__own")).alias("__part"))


class Unions:
    """Connected labels of the rows of one batch; the root of a part is its smallest id."""

    def __init__(self, ids: np.ndarray):
        self.ids = ids
        self.label = np.arange(len(ids))

    def _root(self, i: int) -> int:
        label = self.label
        while label[i] != i:
            label[i] = label[label[i]]
            i = label[i]
        return i

    def link(self, a: np.ndarray, b: np.ndarray) -> None:
        """Join rows ``a`` with rows ``b``; pairs that are joined already cost no Python step."""
        apart = self.label[a] != self.label[b]
        if not apart.any():
            return
        for i, j in zip(a[apart].tolist(), b[apart].tolist()):
            i, j = self._root(i), self._root(j)
            if i != j:
                if self.ids[i] > self.ids[j]:
                    i, j = j, i
                self.label[j] = i
        while True:
            up = self.label[self.label]
            if (up == self.label).all():
                return
            self.label = up


def as_long(batch, name: str) -> np.ndarray:
    return batch.column(name).to_numpy().astype(np.int64, copy=False)
