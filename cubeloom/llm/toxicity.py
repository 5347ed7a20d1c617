"""Toxicity: a learned weighted lexicon, matched by Aho-Corasick in folded text."""

from __future__ import annotations

import hashlib
import math
import re
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import add_columns, held_out, in_training, stored, table, text_blocks, without

# fixed values: letters of other scripts and signs that look like a Latin letter
HOMOGLYPHS = {
    "a": "аαɑ", "b": "Ьƅ", "c": "сϲ", "d": "ԁ", "e": "еєε", "g": "ɡ", "h": "һ", "i": "іıɩι", "j": "ј", "k": "кκ", "l": "ӏⅼ",
    "m": "м", "n": "ո", "o": "оοσ", "p": "рρ", "q": "ԛ", "r": "г", "s": "ѕ", "t": "тτ", "u": "υս", "v": "ѵν", "w": "ԝω", "x": "хχ",
    "y": "уү", "z": "ᴢ",
}
# fixed values: digits and signs used in place of a letter
DIGITS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s"}
# fixed values: phrases in which a lexicon word is harmless
EXCEPTIONS = ("trash can", "trash bin", "trash bag", "trash collection", "clown fish", "circus clown", "white trash bag", "sore loser board")

_FOLD = {ord(c): latin for latin, twins in HOMOGLYPHS.items() for c in twins + twins.upper()} | {ord(d): c for d, c in DIGITS.items()}
_FULL = {0xFF21 + i: chr(97 + i) for i in range(26)} | {0xFF41 + i: chr(97 + i) for i in range(26)}
_WORD = re.compile(r"[^\W_]+")
STEMS = (4, 5, 6, 7)  # lengths of word beginnings that may become lexicon entries


def fold(text: str) -> str:
    """Lower case, look-alikes and digits as letters, words set apart by single spaces (also at both ends).

    A word of digits only stays as it is, so numbers don't turn into words.
    """
    text = text.lower()
    if text.isascii() and not _SIGNS.search(text):
        words = _LETTERS.findall(text)
    elif text.isascii():
        words = [w if w.isdigit() else w.translate(_FOLD) if not w.isalpha() else w for w in _ASCII.findall(text)]
    else:
        words = [w if w.isdigit() else w.translate(_FOLD | _FULL) if not (w.isascii() and w.isalpha()) else w for w in _ANY.findall(text)]
    return f" {' '.join(words)} "


# a sign that stands for a letter belongs to a word only between letters
_ASCII = re.compile(r"[a-z0-9](?:[a-z0-9]|[@$](?=[a-z0-9]))*|[@$](?=[a-z])(?:[a-z0-9]|[@$](?=[a-z0-9]))*")
_SIGNS, _LETTERS = re.compile(r"[0-9@$]"), re.compile(r"[a-z]+")
_ANY = re.compile(r"(?:[^\W_]|[@$](?=[^\W_]))+")


@dataclass(frozen=True)
class Model:
    """Weights of folded entries (" idiot " a word, " idio" a beginning) and the curve from hits to a score."""

    weights: dict[str, float]
    slope: float
    bias: float

    def automaton(self) -> ahocorasick.Automaton:
        found = ahocorasick.Automaton()
        for phrase in EXCEPTIONS:
            found.add_word(fold(phrase), (len(fold(phrase)), None))
        for entry, weight in self.weights.items():
            if entry not in found:
                found.add_word(entry, (len(entry), weight))
        found.make_automaton()
        return found


def hits(folded: str, automaton: ahocorasick.Automaton) -> float:
    """Sum of the weights in a folded text; a word counts once, by its heaviest entry.

    An entry inside an exception phrase does not count.
    """
    words: dict[int, float] = {}
    harmless: list[tuple[int, int]] = []
    for end, (length, weight) in automaton.iter(folded):
        start = end - length + 1
        if weight is None:
            harmless.append((start, end))
        elif weight > words.get(start, 0.0):
            words[start] = weight
    if harmless and words:
        harmless.sort()
        i, reach, total = 0, -1, 0.0
        for start in sorted(words):  # both in order: one pass
            while i < len(harmless) and harmless[i][0] <= start:
                reach = max(reach, harmless[i][1])
                i += 1
            if start >= reach:
                total += words[start]
        return total
    return sum(words.values())


def strength(total: float, words: int) -> float:
    """Weight per fourth root of the length in words: long texts need more, but far from in proportion."""
    return total / math.sqrt(math.sqrt(max(words, 8)))


def entries_of(folded: str) -> set[str]:
    """Words and word beginnings of a folded text."""
    found: set[str] = set()
    for word in set(folded.split()):
        found.add(f" {word} ")
        found.update(f" {word[:n]}" for n in STEMS if len(word) > n)
    return found


def _labelled_rows(docs: DataFrame, labels: DataFrame, sample: int) -> DataFrame:
    """Labelled texts that may be learned from, folded, as ``toxic, text``; one label per id (the highest).

    Copies are one: of the ids with the same text and label the smallest is kept, ``sample``
    ids at most per label are drawn from those by their hash, and of texts that are equal
    when folded one row is left. Only ids and hashes are shuffled, no text.
    """
    marks = labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & in_training()).groupBy(
        F.col("doc_id").cast("long").alias("id")).agg(F.max("toxic").cast("int").alias("toxic"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    hashes = rows.select("doc_id", F.xxhash64("text").alias("copy"))
    marks = hashes.join(marks, F.col("doc_id") == F.col("id")).groupBy("copy", "toxic").agg(F.min("id").alias("id")).withColumn("h", F.xxhash64("id"))
    drawn = marks.where("toxic = 1").orderBy("h", "id").limit(sample).unionByName(marks.where("toxic = 0").orderBy("h", "id").limit(sample))
    # an id with several texts may be drawn more than once
    drawn = drawn.groupBy("id").agg(F.first("toxic").alias("toxic"))
    rows = rows.join(F.broadcast(drawn), F.col("doc_id") == F.col("id")).select("toxic", "text")

    def folded(batches):
        for batch in text_blocks(batches, "text"):
            texts = [fold(text or "") for text in batch.column("text").to_pylist()]
            copies = [hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=16).digest() for text in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column("toxic"), pa.array(texts, pa.string()), pa.array(copies, pa.binary())], names=["toxic", "text", "copy"])

    found = rows.mapInArrow(folded, "toxic int, text string, copy binary").withColumn("row", F.monotonically_increasing_id())
    found = stored(found, "labelled-rows")
    kept = found.groupBy("toxic", "copy").agg(F.min("row").alias("row"))
    return found.join(F.broadcast(kept.select("row")), "row", "left_semi").select("toxic", "text")


def learn(docs: DataFrame, labels: DataFrame, least_docs: int = 4, most_entries: int = 20_000, sample: int = 20_000) -> Model:
    """A lexicon and its curve from labelled training rows, ``sample`` at most per label.

    Entries are whole words and word beginnings of folded whole texts, counted by label. One is kept if its smoothed log odds for label 1 exceed those of
    all rows by 3 and at least ``least_docs`` different texts with label 1 have it; a group
    of copies is one text. The strongest
    ``most_entries`` stay. The curve is a logistic function of ``strength``. Texts are
    reduced to numbers in tasks; the driver sees the lexicon and two numbers per row.
    Without any label 1 nothing is toxic.
    """
    rows = _labelled_rows(docs, labels, sample)
    totals = {r["toxic"]: r["count"] for r in rows.groupBy("toxic").count().collect()}
    n1, n0 = totals.get(1, 0), totals.get(0, 0)
    if not n1:
        return Model({}, 0.0, -10.0)

    def counted(batches):
        counts: dict[str, int] = {}
        for batch in text_blocks(batches, "text"):
            for text in batch.column("text").to_pylist():
                for entry in entries_of(text):
                    counts[entry] = counts.get(entry, 0) + 1
                if len(counts) > 50_000:
                    yield _counts(counts)
                    counts = {}
        if counts:
            yield _counts(counts)

    def _counts(counts):
        return pa.RecordBatch.from_arrays([pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())], names=["entry", "n"])

    def entries(label: int, name: str) -> DataFrame:
        return rows.where(F.col("toxic") == label).mapInArrow(counted, "entry string, n long").groupBy("entry").agg(F.sum("n").alias(name))

    candidates, clean = entries(1, "n1").where(F.col("n1") >= least_docs), entries(0, "n0")
    odds = F.log((F.col("n1") + 0.5) / (n1 + 1.0)) - F.log((F.coalesce("n0", F.lit(0)) + 0.5) / (n0 + 1.0))
    lexicon = candidates.join(clean, "entry", "left").select("entry", odds.alias("w")).where("w > 3").orderBy(F.desc("w"), "entry").limit(most_entries)
    weights = {r["entry"]: float(r["w"]) for r in lexicon.collect()}
    # a word whose beginning says as much needs no entry of its own
    weights = {e: w for e, w in weights.items()
               if not any(weights.get(e[: n + 1], 0.0) >= w for n in STEMS if n + 1 < len(e.rstrip()))}
    model = Model(weights, 1.0, 0.0)

    def measured(batches):
        automaton = model.automaton()
        for batch in text_blocks(batches, "text"):
            x = []
            for folded in batch.column("text").to_pylist():
                x.append(strength(hits(folded, automaton), folded.count(" ") - 1))
            yield pa.RecordBatch.from_arrays([batch.column("toxic"), pa.array(x, pa.float64())], names=["toxic", "x"])

    points = rows.select("toxic", "text").mapInArrow(measured, "toxic int, x double").toPandas()
    x, y = points["x"].to_numpy(), (points["toxic"].to_numpy() == 1).astype(float)
    return Model(weights, *_curve(x, y))


def _curve(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and bias of a logistic curve over log(1 + x), by damped Newton steps."""
    z = np.log1p(x)
    scale = max(z.max(), 1e-9)
    a = np.stack([z / scale, np.ones_like(z)], axis=1)
    theta = np.array([4.0, -2.0])
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(a @ theta, -30, 30)))
        gradient = a.T @ (p - y) + 1e-2 * theta
        curvature = (a * (p * (1 - p))[:, None]).T @ a + 1e-2 * np.eye(2)
        step = np.linalg.solve(curvature, gradient)
        theta = theta - np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return float(theta[0] / scale), float(theta[1])


def score_of(model: Model, total: float, words: int) -> float:
    """0 to 1; a text without a hit gets the score of strength 0."""
    z = math.log1p(strength(total, words)) * model.slope + model.bias
    return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


def score_documents(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """Add ``score`` and ``predicted`` to every row of ``docs``.

    Only the text is looked at, all of it; a null counts as empty, and an empty text has the
    score of a text without hits. Rows are independent, so there is no shuffle. Columns of
    the input named like an added one are replaced.
    """
    rows = without(docs, "score", "predicted")

    def mapped(batches):
        automaton = model.automaton()
        for batch in text_blocks(batches, text_col):
            scores = []
            for text in batch.column(text_col):
                folded = fold(text.as_py() or "")
                scores.append(score_of(model, hits(folded, automaton), folded.count(" ") - 1))
            yield add_columns(batch, {"score": pa.array(scores, pa.float64()), "predicted": pa.array([int(s >= 0.5) for s in scores], pa.int32())})

    return rows.mapInArrow(mapped, T.StructType([*rows.schema, T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())]))


def op8_toxicity(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = learn(docs, table(spark, sf_dir, "labels"))
    return score_documents(docs.select("doc_id", "text"), model).select(
        "doc_id", held_out().alias("held_out"), "score", "predicted")
