"""Line dedup: two Bloom filters find suspected repeats, only those are confirmed exactly."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import add_columns, stored, text_blocks, whole_groups, without

SLICE = 1 << 16  # bits of one slice of a filter
BLANKS = b" \t\n\x0b\x0c\r"


def line_key(line: bytes, least: int) -> bytes | None:
    """The key of a line (stripped, A-Z lower-cased), or nothing if it has under ``least`` code points."""
    key = line.strip(BLANKS)
    if len(key) < least:
        return None
    if not key.isascii() and len(key.decode("utf-8", "replace")) < least:
        return None
    return key.lower()


def _texts(batch, name: str) -> list[bytes]:
    return [t if t is not None else b"" for t in batch.column(name).cast(pa.binary()).to_pylist()]


def filter_bits(docs: DataFrame, text_col: str, bits_per_line: int, most_bits: int) -> int:
    """Filter size: a power of two with ``bits_per_line`` bits for every line, up to ``most_bits``."""
    lines = docs.select(F.sum(F.size(F.split(F.col(text_col), "\n")).cast("long"))).first()[0] or 1
    bits = SLICE
    while bits < lines * bits_per_line and bits < most_bits:
        bits *= 2
    return bits


def _positions(hashes: np.ndarray, bits: int) -> np.ndarray:
    """Two bit positions for each 64-bit hash."""
    mask = np.uint64(bits - 1)
    return np.stack([hashes & mask, (hashes >> np.uint64(31)) * np.uint64(0x9E3779B1) >> np.uint64(7) & mask]).astype(np.int64)


def seen_twice(docs: DataFrame, least: int, bits: int, text_col: str) -> bytes:
    """The filter of keys that may be in two documents or more, as ``bits`` bits.

    A task hashes the keys of its documents (each key of a document once) into a filter of
    keys seen once and one of keys seen twice, and ships both as sorted positions per slice,
    or as the slice's bits where that is shorter. Slices are merged as a stream: a bit that
    two tasks have seen once, or one has seen twice, is seen twice. No repeated key is lost;
    a bit that different keys share only makes a suspect more.
    """

    def local(batches):
        found = []
        for batch in text_blocks(batches, text_col):
            for text in _texts(batch, text_col):
                keys = {k for line in text.split(b"\n") if (k := line_key(line, least)) is not None}
                if keys:
                    found.append(np.fromiter((xxhash.xxh3_64_intdigest(k) for k in keys), np.uint64, len(keys)))
        if not found:
            return
        hashes, counts = np.unique(np.concatenate(found), return_counts=True)
        once = np.unique(_positions(hashes, bits))
        # a bit that two keys of one task share is not two documents with one key
        twice = np.unique(_positions(hashes[counts > 1], bits))
        both = [np.split(x & (SLICE - 1), np.flatnonzero(np.diff(x // SLICE)) + 1) for x in (once, twice)]
        for kind, (all_bits, parts) in enumerate(zip((once, twice), both)):
            if not len(all_bits):
                continue
            numbers = np.unique(all_bits // SLICE)
            packed = []
            for part in parts:
                offsets = part.astype("<u2")
                if offsets.nbytes >= SLICE // 8:
                    dense = np.zeros(SLICE, np.uint8)
                    dense[part] = 1
                    packed.append(np.packbits(dense).tobytes())
                else:
                    packed.append(offsets.tobytes())
            yield pa.RecordBatch.from_arrays(
                [pa.array(numbers.astype(np.int32)), pa.array(np.full(len(numbers), kind + 1, np.int32)), pa.array(packed, pa.binary())],
                names=["slice", "times", "positions"])

    def merged(batches):
        for group in whole_groups(batches, "slice"):
            numbers = group.column("slice").to_numpy()
            times, positions = group.column("times").to_pylist(), group.column("positions").to_pylist()
            bounds = np.flatnonzero(np.r_[True, numbers[1:] != numbers[:-1], True])
            out_number, out_bits = [], []
            for start, stop in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
                count = np.zeros(SLICE, np.int32)
                for i in range(start, stop):
                    raw = positions[i]
                    if len(raw) == SLICE // 8:
                        count += np.unpackbits(np.frombuffer(raw, np.uint8)) * np.int32(times[i])
                    else:
                        count[np.frombuffer(raw, "<u2")] += times[i]
                if (count > 1).any():
                    out_number.append(int(numbers[start]))
                    out_bits.append(np.packbits(count > 1).tobytes())
            if out_number:
                yield pa.RecordBatch.from_arrays([pa.array(out_number, pa.int32()), pa.array(out_bits, pa.binary())], names=["slice", "bits"])

    slices = docs.mapInArrow(local, "slice int, times int, positions binary").repartition("slice").sortWithinPartitions("slice")
    whole = bytearray(bits // 8)
    for number, raw in slices.mapInArrow(merged, "slice int, bits binary").toLocalIterator():
        whole[number * SLICE // 8 : (number + 1) * SLICE // 8] = raw
    return bytes(whole)


def dedup_lines(docs: DataFrame, least: int = 40, documents: int = 5, bits_per_line: int = 16, most_bits: int = 1 << 30,
                id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Drop lines whose key is in at least ``documents`` documents, except in the largest id that has it.

    ``text`` is replaced by the other lines, joined by a newline; ``n_lines`` (before) and
    ``n_dropped`` are added. A null or empty text is one empty line and becomes "". The two
    filters (``most_bits`` bits each at most, the only thing that is broadcast) say which
    lines can be repeats at all; with too small a filter more lines are suspects, the result
    is the same. Suspects are counted by their whole key, each document once, partly before
    the shuffle; the keys to drop join the suspects by a 128-bit digest and come back as one
    list per document. Rows are documents: rows that repeat an id count one by one, and
    share their decision. Ids may be null: the largest id is then taken among the others,
    and null ids keep a line only where no other document with it has an id.
    Columns of the input named like an added one are replaced.
    """
    rows = without(docs, "n_lines", "n_dropped")
    data = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    bits = filter_bits(data, "text", bits_per_line, most_bits)
    shared = docs.sparkSession.sparkContext.broadcast(seen_twice(data.select("text"), least, bits, "text"))

    def suspects(batches):
        seen = np.frombuffer(shared.value, np.uint8)

        def hit(positions: np.ndarray) -> np.ndarray:
            return seen[positions >> 3] >> (7 - (positions & 7)).astype(np.uint8) & 1

        for batch in text_blocks(batches, "text"):
            at, keys = [], []
            for i, text in enumerate(_texts(batch, "text")):
                own = {k for line in text.split(b"\n") if (k := line_key(line, least)) is not None}
                at += [i] * len(own)
                keys += own
            if not keys:
                continue
            hashes = np.fromiter((xxhash.xxh3_64_intdigest(k) for k in keys), np.uint64, len(keys))
            first, second = _positions(hashes, bits)
            maybe = np.flatnonzero(hit(first) & hit(second))
            chosen = [keys[j] for j in maybe.tolist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id").take(pa.array(np.array(at, np.int64)[maybe])), pa.array(chosen, pa.binary()),
                 pa.array([_digest(k) for k in chosen], pa.binary())], names=["id", "key", "digest"])

    found = stored(data.mapInArrow(suspects, "id long, key binary, digest binary"), "suspected-lines")
    repeats = found.groupBy("key").agg(F.count("*").alias("n"), F.max("id").alias("keeper"), F.first("digest").alias("d"))
    repeats = stored(repeats.where(F.col("n") >= documents).select("d", "keeper"), "repeated-lines")
    drops = found.join(repeats, F.col("digest") == F.col("d")).where(~F.col("id").eqNullSafe(F.col("keeper")))
    drops = stored(drops.groupBy("id").agg(F.collect_set("digest").alias("__digests")), "dropped-lines")
    # one plan at every size: documents and their lists meet by a shuffle that can spill
    joined = rows.join(drops.withColumnRenamed("id", "__id").hint("merge"), F.col(f"`{id_col}`").eqNullSafe(F.col("__id")), "left").drop("__id")
    where = rows.columns.index(text_col)

    def cut(batches):
        for batch in text_blocks(batches, text_col):
            drop_lists = batch.column("__digests").to_pylist()
            batch = batch.drop_columns(["__digests"])
            texts, total, dropped = [], [], []
            for text, gone in zip(_texts(batch, text_col), drop_lists):
                lines = text.split(b"\n")
                kept = lines
                if gone:
                    gone = set(gone)
                    kept = [x for x in lines if (k := line_key(x, least)) is None or _digest(k) not in gone]
                texts.append(b"\n".join(kept))
                total.append(len(lines))
                dropped.append(len(lines) - len(kept))
            columns = list(batch.columns)
            columns[where] = pa.array(texts, pa.binary()).cast(pa.string())
            out = pa.RecordBatch.from_arrays(columns, names=batch.schema.names)
            yield add_columns(out, {"n_lines": pa.array(total, pa.int64()), "n_dropped": pa.array(dropped, pa.int64())})

    schema = T.StructType([*[T.StructField(f.name, T.StringType() if f.name == text_col else f.dataType) for f in rows.schema],
                           T.StructField("n_lines", T.LongType()), T.StructField("n_dropped", T.LongType())])
    return joined.mapInArrow(cut, schema)


def _digest(key: bytes) -> bytes:
    return hashlib.blake2b(key, digest_size=16).digest()


def op6_line_dedup(spark, sf_dir: str) -> DataFrame:
    from .common import table

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return dedup_lines(docs).select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


# The keys of lines and their documents, counted and joined in one go.
OP6_SQL = r"""
WITH lines AS (
  SELECT doc_id, p.i AS i, p.l AS line,
         translate(trim(p.l, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM (SELECT doc_id, unnest(list_transform(parts, lambda l, j: {'i': j, 'l': l})) AS p
        FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents))
), repeats AS (
  SELECT key, max(doc_id) AS keeper FROM lines WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5
), marked AS (
  SELECT l.doc_id, l.i, l.line, r.key IS NOT NULL AND l.doc_id <> r.keeper AS gone
  FROM lines l LEFT JOIN repeats r ON l.key = r.key
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""
