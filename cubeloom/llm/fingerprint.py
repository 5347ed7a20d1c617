"""Homomorphic document fingerprints: sums of wide vectors hashed from paragraphs.

Everything here is a Column expression or a join; no row leaves the JVM.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored, table

WORDS = 48  # three signed bytes of a hash each; every byte has a lane, a long, of its own
LANES = 3 * WORDS
MODULUS = 48  # lanes and the number of pieces are sums modulo 2^48, as signed residues; two residues add up within a long
FEW = 1024  # pieces up to which the mean of a signed byte, -1/2, is lost in the error of a likeness
BLOCK = 23  # pieces are first summed in blocks of 2^23, where a sum stays below 2^30 and two fit in a long
PARAGRAPHS = r"(?<=\n)|(?<=[.!?] )"  # cut points; every piece keeps what ends it


def _pair(h: Column, first: int) -> Column:
    """Two signed bytes of a hash, from bit ``first`` on, in the halves of a long."""
    low, high = (F.shiftright(F.shiftleft(h, 56 - first - 8 * i), 56) for i in range(2))
    return low + high * F.lit(1 << 32)


def _halves(pair: Column) -> tuple[Column, Column]:
    """The two signed sums in a long."""
    low = F.shiftright(F.shiftleft(pair, 32), 32)
    return low, F.shiftright(pair - low, 32)


def _residue(total: Column) -> Column:
    """The signed residue modulo 2^``MODULUS``."""
    return F.shiftright(F.shiftleft(total, 64 - MODULUS), 64 - MODULUS)


def fingerprints(rows: DataFrame, keys: list[str], text_col: str) -> DataFrame:
    """``keys`` and ``fp``, the fingerprint of the text as an array of longs; a null counts as the empty text.

    ``keys`` tell the rows apart. The text is cut behind each newline and behind each
    sentence end, so that a text of one long paragraph has parts as well; the pieces form a
    multiset (their order is of no account, their number is). Each piece is hashed by
    SHA-256, the hash is stretched to ``LANES`` signed bytes, and each byte is summed over the
    pieces modulo 2^``MODULUS`` in a long of its own; behind the lanes stands the number of
    pieces. Fingerprints thus add up without end (``insert`` over a corpus never overflows),
    and below 2^40 pieces, more than a text can have, the residues are the sums. Texts with equal pieces have equal fingerprints;
    ``insert`` and ``delete`` follow an edit without the rest of the text. Pieces of a row
    are summed where the row is: rows dealt out by some of ``keys`` are not shuffled again.
    """
    pieces = rows.select(*keys, F.posexplode(F.split(F.coalesce(F.col(text_col), F.lit("")), PARAGRAPHS)).alias("__n", "__p"))
    seeds = pieces.select(*keys, F.shiftright("__n", BLOCK).alias("__b"), F.sha2(F.col("__p").cast("binary"), 256).alias("__s"))
    hashes = seeds.select(*keys, "__b", *[F.xxhash64("__s", F.lit(j)).alias(f"__h{j}") for j in range(WORDS // 2)])
    pairs = [_pair(F.col(f"__h{i // 3}"), 16 * (i % 3)) for i in range(LANES // 2)]
    blocks = hashes.groupBy(*keys, "__b").agg(F.count(F.lit(1)).alias("__c"), *[F.sum(p).alias(f"__w{i}") for i, p in enumerate(pairs)])
    lanes = [half for i in range(LANES // 2) for half in _halves(F.col(f"__w{i}"))]
    sums = blocks.groupBy(*keys).agg(*[F.sum(lane).alias(f"__l{i}") for i, lane in enumerate([*lanes, F.col("__c")])])
    return sums.select(*keys, F.array(*[_residue(F.col(f"__l{i}")) for i in range(LANES + 1)]).alias("fp"))


def insert(a: Column, b: Column) -> Column:
    """The fingerprint of both multisets together."""
    return F.zip_with(a, b, lambda x, y: _residue(x + y))


def delete(a: Column, b: Column) -> Column:
    """The fingerprint of ``a`` without the pieces of ``b``."""
    return F.zip_with(a, b, lambda x, y: _residue(x - y))


def as_text(fp: Column) -> Column:
    return F.array_join(F.transform(fp, lambda w: F.lpad(F.lower(F.hex(w)), 16, "0")), "")


def _lanes(fp: Column) -> Column:
    """The lane sums as doubles, moved to mean zero where pieces are many."""
    n = F.element_at(fp, -1)
    shift = F.when(n > FEW, n / 2.0).otherwise(F.lit(0.0))
    return F.transform(F.slice(fp, 1, LANES), lambda x: x.cast("double") + shift)


def _product(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(_lanes(a), _lanes(b), lambda x, y: x * y), F.lit(0.0), lambda acc, z: acc + z)


def _norm(a: Column) -> Column:
    return F.aggregate(_lanes(a), F.lit(0.0), lambda acc, x: acc + x * x)


def likeness(a: Column, b: Column, norm_a: Column | None = None, norm_b: Column | None = None) -> Column:
    """How alike the multisets behind two fingerprints are, from 0 to 1.

    The lanes are sums of independent values of mean zero (-1/2 for up to ``FEW`` pieces), so
    the cosine of two fingerprints estimates the cosine of the piece counts (error about 1 / sqrt(LANES)); negative
    estimates are 0, equal fingerprints are 1.
    """
    size = F.sqrt(norm_a if norm_a is not None else _norm(a)) * F.sqrt(norm_b if norm_b is not None else _norm(b))
    cosine = F.when(size > 0, _product(a, b) / size).otherwise(F.lit(0.0))
    return F.when(a == b, F.lit(1.0)).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), cosine)))


def _number(key: Column, cuts: list[int]) -> Column:
    """How many of the sorted cuts are below ``key``, by binary search."""
    steps, step = [], 1
    while step * 2 <= len(cuts) + 1:
        step *= 2
    while step:
        steps.append(step)
        step //= 2
    bounds = F.lit(cuts) if cuts else F.array().cast("array<long>")
    found = F.aggregate(
        F.array(*[F.lit(s) for s in steps]), F.lit(0),
        lambda low, s: F.when(F.get(bounds, low + s - 1) < key, low + s).otherwise(low))
    return F.when(key.isNull(), F.lit(0)).otherwise(found)


def with_next(docs: DataFrame) -> DataFrame:
    """``r, place, guest, id, text, next_text``: each document with the next one in descending order of id.

    After the smallest comes the largest; ties are ordered by text, null ids come last. Ids
    are cut into ranges of about equal row counts (a mergeable sketch over all ids gives the
    cuts), and the window runs per range. The largest document of each range is also dealt
    to the range above as a guest, behind all others, so every row meets its successor in
    one shuffle (rows of a range ``r`` stay in one task, in order of ``place``). Ranges are
    two to sixteen times as many as shuffle partitions; only the cuts come to the driver.
    """
    spark = docs.sparkSession
    wanted, ranges = int(spark.conf.get("spark.sql.shuffle.partitions")), 8
    while ranges < 2 * wanted:
        ranges *= 2
    data = docs.select(F.col("doc_id").cast("long").alias("id"), F.col("text").cast("string").alias("text"))
    cuts = data.agg(F.percentile_approx("id", [i / ranges for i in range(1, ranges)], 20 * ranges)).first()[0] or []
    data = data.withColumn("range", _number(F.col("id"), sorted(set(cuts))))
    heads = data.groupBy("range").agg(F.max("id").alias("head"))
    order = Window.orderBy("range")  # one row per range
    heads = heads.withColumn("above", F.coalesce(F.lead("range").over(order), F.min("range").over(Window.partitionBy())))
    heads = stored(heads.withColumnRenamed("range", "r"), "range-heads")
    places = F.when(F.col("id").eqNullSafe(F.col("head")), F.array(
        F.struct(F.col("range").alias("r"), F.lit(False).alias("guest")), F.struct(F.col("above").alias("r"), F.lit(True).alias("guest"))
    )).otherwise(F.array(F.struct(F.col("range").alias("r"), F.lit(False).alias("guest"))))
    dealt = data.join(heads, F.col("range") == F.col("r")).select("id", "text", F.explode(places).alias("p")).select("id", "text", "p.r", "p.guest")
    inside = Window.partitionBy("r").orderBy("guest", F.desc_nulls_last("id"), F.asc_nulls_first("text"))
    return dealt.repartition("r").select(
        "r", F.row_number().over(inside).alias("place"), "guest", "id", "text", F.lead("text").over(inside).alias("next_text"))


def edited(text: Column, following: Column) -> Column:
    """The text with its last third replaced by the first code points of the next text."""
    n = F.char_length(text)
    cut = F.floor(n / 3).cast("int")
    return F.concat(F.substring(text, F.lit(1), n - cut), F.substring(following, F.lit(1), cut))


def document_fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprints of all texts and of their edited texts, with the likeness to those and to the next document.

    Returns ``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited,
    near_next``; nulls count as empty texts, one document is its own successor, repeated
    rows follow one another, and other columns are not read.
    """
    text, following = F.coalesce("text", F.lit("")), F.coalesce("next_text", F.lit(""))
    rows = with_next(docs.select("doc_id", "text")).select(
        "r", "place", "guest", "id", F.char_length(text).cast("long").alias("n_chars"), text.alias("text"), edited(text, following).alias("edited"))
    rows = rows.withColumn("edited_sha256", F.sha2(F.col("edited").cast("binary"), 256))
    own = F.struct(F.lit(False).alias("after"), F.col("text").alias("text"))
    both = F.when(F.col("guest"), F.array(own)).otherwise(F.array(own, F.struct(F.lit(True).alias("after"), F.col("edited").alias("text"))))
    facts = ["r", "place", "guest", "id", "n_chars", "edited_sha256"]
    texts = rows.select(*facts, F.explode(both).alias("v")).select(*facts, "v.after", "v.text")
    found = fingerprints(texts, [*facts, "after"], "text").groupBy(*facts).agg(
        F.max(F.when(~F.col("after"), F.col("fp"))).alias("fp"), F.max(F.when(F.col("after"), F.col("fp"))).alias("edited_fp"))
    found = found.withColumn("next_fp", F.lead("fp").over(Window.partitionBy("r").orderBy("place"))).where("not guest")
    norm = _norm(F.col("fp"))
    return found.select(
        F.col("id").alias("doc_id"), "n_chars", "edited_sha256",
        as_text(F.col("fp")).alias("fingerprint"), as_text(F.col("edited_fp")).alias("edited_fingerprint"),
        likeness(F.col("fp"), F.col("edited_fp"), norm).alias("near_edited"),
        likeness(F.col("fp"), F.col("next_fp"), norm).alias("near_next"))


def op1_document_fingerprints(spark, sf_dir: str) -> DataFrame:
    return document_fingerprints(table(spark, sf_dir, "documents"))
