"""Near-duplicate vectors: random-hyperplane sign hashing, exact cosine check, components."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Unions, as_long, in_blocks, stored, whole_groups, without
from .components import components

BLOCK = 1024  # rows of one block of a bucket; a task holds two blocks


def plan_tables(n: int, threshold: float, per_bucket: float = 32.0, miss: float = 1e-3) -> tuple[int, int]:
    """Sign bits of a table and number of tables for ``n`` vectors.

    Bits grow with log2(n), so a bucket of unrelated vectors stays near ``per_bucket``
    rows at every size. The number of tables follows from them: a pair at the threshold
    itself shares no bucket with probability ``miss`` at most, closer pairs far less.
    """
    bits = min(62, max(4, round(math.log2(max(n, 1) / per_bucket + 1))))
    same = (1 - math.acos(threshold) / math.pi) ** bits
    return bits, max(1, math.ceil(math.log(miss) / math.log1p(-same)))


def near_vectors(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", threshold: float = 0.9,
                 seed: int = 42, miss: float = 1e-3) -> DataFrame:
    """Add ``n_links``, ``component_id`` and ``kept`` to every row of ``vectors``.

    Equal vectors are folded into one with a count first. Each distinct vector goes to one
    bucket of each table (the signs of its products with random hyperplanes); inside a
    bucket all pairs are compared by cosine in double precision, and a pair that meets in
    several tables counts in the first of them only. Buckets of any size are cut into
    blocks, and a task compares two blocks at a time, emitting one row per vector (its
    links and the root of its local component), never pairs.

    Null, zero and non-finite vectors, vectors with null components and rows with a null
    id link with nothing: ``n_links`` 0, their own id as ``component_id``, ``kept`` true
    (false where the id is null). Vectors of different lengths never link. Rows that repeat
    an id count as vectors of their own in ``n_links`` and as one node of a component.
    Columns of the input named like an added one are replaced.
    """
    spark = vectors.sparkSession
    rows = without(vectors, "n_links", "component_id", "kept")
    data = vectors.select(F.col(id_col).cast("long").alias("__id"), F.col(vec_col).cast("array<double>").alias("__v"))
    usable = (F.col("__id").isNotNull() & (F.size("__v") > 0)
              & F.forall("__v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
              & F.exists("__v", lambda x: x != 0))
    classes = stored(data.where(F.coalesce(usable, F.lit(False))).groupBy("__v").agg(
        F.min("__id").alias("__rep"), F.count("*").alias("__copies")), "vector-classes")
    bits, tables = plan_tables(classes.count(), threshold, miss=miss)

    def planes(dim: int) -> np.ndarray:
        return np.random.default_rng([seed, dim]).standard_normal((dim, bits * tables))

    weights = np.int64(1) << np.arange(bits, dtype=np.int64)

    def unit(v: np.ndarray) -> np.ndarray:
        v = v / np.abs(v).max(axis=1, keepdims=True)
        return v / np.sqrt((v * v).sum(axis=1, keepdims=True))

    def buckets_of(v: np.ndarray) -> np.ndarray:
        signs = (v @ planes(v.shape[1]) > 0).reshape(len(v), tables, bits)
        return signs @ weights

    def hashed(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            dims = np.asarray(batch.column("__v").value_lengths())
            for dim in np.unique(dims):
                part = batch.filter(pa.array(dims == dim))
                v = part.column("__v").flatten().to_numpy().reshape(-1, dim)
                found = buckets_of(unit(v))
                for i in range(0, len(v), 1000):
                    keys = found[i : i + 1000].reshape(-1)
                    at = np.repeat(np.arange(i, min(i + 1000, len(v))), tables)
                    table = np.tile(np.arange(tables, dtype=np.int32), len(at) // tables)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(table), pa.array(keys), *part.take(pa.array(at)).columns],
                        names=["__table", "__bucket", *part.schema.names])

    spread = classes.mapInArrow(hashed, "__table int, __bucket long, __v array<double>, __rep long, __copies long")
    spread = spread.withColumn("__key", F.xxhash64("__table", "__bucket", F.size("__v"))).drop("__bucket")
    cells = in_blocks(spread, "__key", "__rep", BLOCK, "vector-buckets")
    cells = cells.repartition("__cell").sortWithinPartitions("__cell")

    def compared(batches):
        for group in whole_groups(batches, "__cell"):
            group = group.combine_chunks()
            cell, ids = as_long(group, "__cell"), as_long(group, "__rep")
            bounds = np.flatnonzero(np.r_[True, cell[1:] != cell[:-1], True])
            sizes = np.diff(bounds)
            part = group.column("__part").to_numpy()
            number = group.column("__table").to_numpy()
            copies = as_long(group, "__copies")
            vectors_of = group.column("__v")
            out_ids, out_roots, out_links = [], [], []
            for start, size in zip(bounds[:-1][sizes > 1].tolist(), sizes[sizes > 1].tolist()):
                lists = vectors_of.slice(start, size).combine_chunks()
                v = unit(lists.flatten().to_numpy().reshape(size, -1))
                here = slice(start, start + size)
                a, b = np.nonzero(np.triu(v @ v.T >= threshold, 1))
                two = part[here][0] >= 0
                if two:
                    across = part[here][a] != part[here][b]
                    a, b = a[across], b[across]
                if not a.size:
                    continue
                near = np.unique(np.r_[a, b])
                own = ids[here]
                joined = Unions(own)
                joined.link(a, b)
                table = int(number[start])
                links = np.zeros(size, np.int64)
                earlier = np.zeros((size, table), np.int64)
                earlier[near] = buckets_of(v[near])[:, :table]
                for i in range(0, len(a), 100_000):
                    x, y = a[i : i + 100_000], b[i : i + 100_000]
                    first = ~(earlier[x] == earlier[y]).any(axis=1)
                    np.add.at(links, x[first], copies[here][y[first]])
                    np.add.at(links, y[first], copies[here][x[first]])
                out_ids.append(own[near])
                out_roots.append(own[joined.label[near]])
                out_links.append(links[near])
            if out_ids:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(x)) for x in (out_ids, out_roots, out_links)], names=["id", "root", "links"])

    found = stored(cells.mapInArrow(compared, "id long, root long, links long"), "vector-links")
    linked = found.groupBy("id").agg(F.sum("links").alias("__others"))
    parts = components(found.select("id", "root"))
    known = classes.join(linked, F.col("__rep") == F.col("id"), "left").drop("id").join(
        parts, F.col("__rep") == F.col("node"), "left").select(
        F.col("__v").alias("__class"), "__copies", "__others", F.coalesce("root", "__rep").alias("__root"))
    key = F.col(f"`{vec_col}`").cast("array<double>")
    out = rows.withColumn("__k", F.when(F.col(f"`{id_col}`").isNotNull(), key)).join(known, F.col("__k") == F.col("__class"), "left")
    return out.select(
        *[F.col(f"`{c}`") for c in rows.columns],
        F.coalesce(F.col("__copies") - 1 + F.coalesce("__others", F.lit(0)), F.lit(0)).cast("long").alias("n_links"),
        F.coalesce(F.col("__root"), F.col(f"`{id_col}`").cast("long")).alias("component_id"),
        F.coalesce(F.col("__root") == F.col(f"`{id_col}`"), F.col("__class").isNull() & F.col(f"`{id_col}`").isNotNull()).alias("kept"),
    )


def op2_embedding_near_dedup(spark, sf_dir: str) -> DataFrame:
    from .common import table

    return near_vectors(table(spark, sf_dir, "embeddings")).select("vec_id", "n_links", "component_id", "kept")
