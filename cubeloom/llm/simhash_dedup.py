"""SimHash near-duplicates: generalised pigeonhole search over fingerprints, then components."""

from __future__ import annotations

import math
from itertools import islice

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Unions, as_long, in_blocks, stored, whole_groups
from .components import components

BITS = 64
BLOCK = 4096  # rows of one block of a bucket; a task holds two blocks


def simhash(text: str | None, words: int = 4, seed: int = 42) -> int:
    """The fingerprint of a whole text as an unsigned number; 0 for a text without words.

    Words are what ASCII white space separates, after A-Z are lower-cased. Every run of
    ``words`` words (the whole sequence where there are fewer) is hashed, repeats included;
    a bit is 1 if more than half of the hashes have it.
    """
    tokens = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not tokens:
        return 0
    line = b" ".join(tokens)
    ends = np.cumsum([len(t) + 1 for t in tokens])
    starts = np.r_[0, ends[:-1]]
    n = max(1, len(tokens) - words + 1)
    digest = xxhash.xxh64_intdigest
    last = ends[min(words, len(tokens)) - 1 :] - 1
    counts = np.zeros(BITS, np.int64)
    pairs = zip(starts[:n].tolist(), last.tolist())
    while True:
        hashes = np.fromiter((digest(line[s:e], seed) for s, e in islice(pairs, 65_536)), dtype=np.uint64)
        if not hashes.size:
            break
        bits = np.unpackbits(hashes.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
        counts += bits.sum(axis=0, dtype=np.int64)
    value = 0
    for one in (counts * 2 > n).tolist():
        value = value << 1 | one
    return value


def fingerprints(docs: DataFrame, words: int = 4, seed: int = 42, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, fp`` per row: the fingerprint as a signed long."""

    def mapped(batches):
        for batch in batches:
            found = np.array([simhash(t.as_py(), words, seed) for t in batch.column(1)], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.view(np.int64))], names=["doc_id", "fp"])

    data = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    return data.mapInArrow(mapped, "doc_id long, fp long")


def bit_statistics(fps: DataFrame) -> tuple[int, np.ndarray, np.ndarray]:
    """Number of fingerprints, how often each bit is set, and how often each two bits are.

    Each task sums its own rows; 64 x 65 counts come to the driver, whatever the input.
    """

    def counted(batches):
        both, n = np.zeros((BITS, BITS), np.int64), 0
        for batch in batches:
            for i in range(0, batch.num_rows, 8192):
                fp = batch.column(0).slice(i, 8192).to_numpy(zero_copy_only=False).astype(np.int64)
                bits = np.unpackbits(fp.astype(">i8").view(np.uint8).reshape(-1, 8), axis=1).astype(np.float32)
                both += (bits.T @ bits).astype(np.int64)
                n += len(fp)
        if n:
            at = np.arange(BITS * BITS + 1, dtype=np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(np.r_[both.ravel(), n])], names=["at", "n"])

    found = fps.select("fp").mapInArrow(counted, "at int, n long").groupBy("at").agg(F.sum("n")).collect()
    flat = np.zeros(BITS * BITS + 1, np.int64)
    for at, n in found:
        flat[at] = n
    both = flat[:-1].reshape(BITS, BITS)
    return int(flat[-1]), both.diagonal().copy(), both


def group_bits(n: int, ones: np.ndarray, both: np.ndarray, parts: int) -> list[list[int]]:
    """Deal the 64 bits to ``parts`` groups of about equal size, correlated bits together.

    Each group starts from the bit that is least tied to the groups there are, and takes the
    bit with the highest mean absolute correlation to its members until it is full.
    """
    p = ones / max(n, 1)
    spread = np.sqrt(np.maximum(p * (1 - p), 1e-12))
    tied = np.abs(both / max(n, 1) - np.outer(p, p)) / np.outer(spread, spread)
    free, groups = set(range(BITS)), []
    for g in range(parts):
        size = len(free) // (parts - g)
        used = [b for group in groups for b in group]
        start = min(sorted(free), key=lambda b: tied[b, used].sum() if used else -tied[b].sum())
        group = [start]
        free.discard(start)
        while len(group) < size:
            best = max(sorted(free), key=lambda b: tied[b, group].sum())
            group.append(best)
            free.discard(best)
        groups.append(sorted(group))
    return groups


def ball(width: int, radius: int) -> int:
    """Values within ``radius`` bits of a value of ``width`` bits; 0 for a radius of -1."""
    return sum(math.comb(width, r) for r in range(radius + 1))


def allot(costs: list[list[float]], total: int) -> list[int]:
    """Thresholds from -1 upwards that sum to ``total`` at least cost, by dynamic programming.

    ``costs[i][t + 1]`` is the cost of threshold ``t`` in partition ``i``.
    """
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for row in costs:
        step: dict[int, tuple[float, list[int]]] = {}
        for spent, (cost, chosen) in best.items():
            for i, c in enumerate(row):
                key = spent + i - 1
                if key not in step or cost + c < step[key][0]:
                    step[key] = (cost + c, [*chosen, i - 1])
        best = step
    return best[total][1]


def plan(fps: DataFrame, distance: int = 4, probe_cost: float = 200.0) -> tuple[list[list[int]], list[int]]:
    """Bit groups and their thresholds, chosen on counts over all fingerprints.

    By the general pigeonhole principle two fingerprints within ``distance`` bits differ in
    at most t_i bits of some group i, for any thresholds (-1: skip the group) with sum
    ``distance`` - groups + 1. So any choice finds all pairs; it only decides the cost.
    The pairs of a group that agree wholly are estimated from the share of agreeing bits for
    the choice of the number of groups, then counted for the chosen one; pairs further
    apart follow from the odds that a bit differs. ``probe_cost`` is the cost of a probe in
    units of one comparison.
    """
    n, ones, both = bit_statistics(fps)
    p = ones / max(n, 1)
    agree = np.clip(p * p + (1 - p) * (1 - p), 1e-9, 1)

    def costs(groups: list[list[int]], equal: list[float]) -> list[list[float]]:
        out = []
        for bits, pairs in zip(groups, equal):
            odds = np.zeros(distance + 1)
            odds[0] = 1
            for b in bits:
                odds[1:] += odds[:-1] * (1 - agree[b]) / agree[b]
            row = [0.0]
            for t in range(distance + 1):
                row.append(probe_cost * n * (1 + (ball(len(bits), t) - 1) / 2) + pairs * float(odds[: t + 1].sum()))
            out.append(row)
        return out

    best = None
    for parts in range(2, distance + 2):
        groups = group_bits(n, ones, both, parts)
        rows = costs(groups, [n * n / 2 * float(agree[bits].prod()) for bits in groups])
        chosen = allot(rows, distance - parts + 1)
        cost = sum(row[t + 1] for row, t in zip(rows, chosen))
        if best is None or cost < best[0]:
            best = (cost, groups)
    groups = best[1]
    counted = fps.select(F.posexplode(F.array(*[value_of("fp", bits) for bits in groups])).alias("g", "v")).groupBy("g", "v").count()
    equal = [0.0] * len(groups)
    for g, pairs in counted.groupBy("g").agg(F.sum(F.col("count").cast("double") * (F.col("count") - 1) / 2)).collect():
        equal[g] = pairs
    return groups, allot(costs(groups, equal), distance - len(groups) + 1)


def value_of(fp: str, bits: list[int]):
    """The bits of a group as a number; bit 0 is the highest of the fingerprint."""
    return F.expr("(" + " | ".join(
        f"shiftleft(shiftrightunsigned({fp}, {BITS - 1 - b}) & 1L, {len(bits) - 1 - i})" for i, b in enumerate(bits)) + ")")


def near_fingerprints(fps: DataFrame, distance: int = 4) -> DataFrame:
    """``id, root`` links between fingerprints within ``distance`` bits; ``fps`` has distinct ``fp`` and their ``rep``.

    Every fingerprint is stored once in each searched group under its value there, and
    probes the values within the group's threshold that are below its own, so of two values
    that differ only the larger one probes. A task compares the rows of a value, two blocks at most, by
    exclusive-or and bit count, and emits one row per fingerprint: the smallest id it is
    joined to there.
    """
    groups, limits = plan(fps, distance)

    def spread(batches):
        masks = []
        for bits, limit in zip(groups, limits):
            found = np.array([0], np.int64)
            steps = np.int64(1) << np.arange(len(bits), dtype=np.int64)
            ring = found
            for _ in range(max(limit, 0)):
                ring = np.unique((ring[:, None] ^ steps[None, :]).ravel())
                found = np.union1d(found, ring)
            masks.append(found if limit >= 0 else found[:0])
        for batch in batches:
            for i in range(0, batch.num_rows, 2000):
                fp = batch.column("fp").slice(i, 2000).to_numpy(zero_copy_only=False).astype(np.int64)
                rep = batch.column("rep").slice(i, 2000).to_numpy(zero_copy_only=False).astype(np.int64)
                for g, bits in enumerate(groups):
                    if not len(masks[g]):
                        continue
                    value = np.zeros(len(fp), np.int64)
                    for b in bits:
                        value = value << 1 | (fp >> (BITS - 1 - b)) & 1
                    probe = value[:, None] ^ masks[g][None, :]
                    at, m = np.nonzero(probe <= value[:, None])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(at), g, np.int32)), pa.array(probe[at, m]), pa.array(probe[at, m] != value[at]),
                         pa.array(fp[at]), pa.array(rep[at])], names=["g", "value", "probe", "fp", "rep"])

    rows = fps.mapInArrow(spread, "g int, value long, probe boolean, fp long, rep long")
    rows = rows.select(F.xxhash64("g", "value").alias("__key"), "probe", "fp", "rep")
    cells = in_blocks(rows, "__key", "fp", BLOCK, "simhash-buckets")
    cells = cells.repartition("__cell").sortWithinPartitions("__cell")

    def compared(batches):
        for group in whole_groups(batches, "__cell"):
            cell, fp, rep = as_long(group, "__cell"), as_long(group, "fp"), as_long(group, "rep")
            probe, part = group.column("probe").to_numpy(), group.column("__part").to_numpy()
            n = len(cell)
            bounds = np.flatnonzero(np.r_[True, cell[1:] != cell[:-1], True])
            end = np.repeat(bounds[1:], np.diff(bounds))
            joined, at, step = Unions(rep), np.arange(n), 1
            while True:
                at = at[at + step < end[at]]
                if not at.size:
                    break
                other = at + step
                near = np.bitwise_count((fp[at] ^ fp[other]).view(np.uint64)) <= distance
                a, b = at[near], other[near]
                ok = ~(probe[a] & probe[b]) & ((part[a] < 0) | (part[a] != part[b]))
                joined.link(a[ok], b[ok])
                step += 1
            roots = rep[joined.label]
            moved = roots != rep
            if moved.any():
                yield pa.RecordBatch.from_arrays([pa.array(rep[moved]), pa.array(roots[moved])], names=["id", "root"])

    return cells.mapInArrow(compared, "id long, root long")


def near_documents(docs: DataFrame, words: int = 4, distance: int = 4, seed: int = 42, id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """``doc_id, fingerprint, component_id`` for every row of ``docs``.

    Documents with equal fingerprints are one node (the smallest id of them), so groups of
    exact copies cost one row each, however large; links between different fingerprints
    come from ``near_fingerprints``, components from joins. Null and empty texts have
    fingerprint 0 and link like any other. A row with a null id gets a fingerprint and the
    component of its fingerprint; it never names one (null where nothing else does).
    Repeated rows get the same answer each. Other columns are not read.
    """
    found = stored(fingerprints(docs, words, seed, id_col, text_col), "fingerprints")
    classes = stored(found.groupBy("fp").agg(F.min("doc_id").alias("rep")), "fingerprint-classes")
    parts = components(near_fingerprints(classes.where("rep is not null"), distance))
    rooted = classes.join(parts, F.col("rep") == F.col("node"), "left").select(
        F.col("fp").alias("__fp"), F.coalesce("root", "rep").alias("component_id"))
    return found.join(rooted, F.col("fp") == F.col("__fp")).select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def drop_near_documents(docs: DataFrame, words: int = 4, distance: int = 4, seed: int = 42) -> DataFrame:
    """The rows of ``docs`` whose id is the smallest of its component; all columns stay.

    Rows with a null id stay: they can't be named as a copy of anything. Rows that repeat a
    kept id stay as well: an id is one document.
    """
    near = near_documents(docs, words, distance, seed)
    gone = stored(near.where("doc_id <> component_id").select(F.col("doc_id").alias("__gone")).distinct(), "near-copies")
    # one plan at every size: a merge join can spill, and its hot keys are split
    return docs.join(gone.hint("merge"), F.col("doc_id") == F.col("__gone"), "left_anti")


def op9_simhash_near_dedup(spark, sf_dir: str) -> DataFrame:
    from .common import table

    return near_documents(table(spark, sf_dir, "documents"))
