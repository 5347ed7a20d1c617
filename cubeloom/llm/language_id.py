"""Language ID: the family first, then one-versus-one linear support vector machines within it."""

from __future__ import annotations

from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import add_columns, held_out, in_training, table, without

# fixed values: families of language codes; a code that is not listed is a family of its own
FAMILIES = {
    "germanic": ("en", "de", "nl", "sv", "da", "no", "nb", "nn", "is", "af", "fy", "lb", "yi"),
    "romance": ("fr", "es", "it", "pt", "ro", "ca", "gl", "oc", "la"),
    "slavic": ("ru", "uk", "be", "pl", "cs", "sk", "sl", "hr", "sr", "bs", "bg", "mk"),
    "baltic": ("lt", "lv"), "uralic": ("fi", "et", "hu"), "turkic": ("tr", "az", "kk", "uz", "ky", "tk"),
    "semitic": ("ar", "he", "mt", "am"), "indic": ("hi", "ur", "bn", "mr", "gu", "pa", "ne", "si"), "iranian": ("fa", "ku", "ps", "tg"),
    "dravidian": ("ta", "te", "kn", "ml"), "malay": ("id", "ms", "jv", "tl"),
}
UNKNOWN = "und"
DIMS = 4096  # hashed features: the first half for pairs, the second for triples of characters
_LETTER = regex.compile(r"\p{L}")


def family_of(lang: str) -> str:
    return next((name for name, codes in FAMILIES.items() if lang.split("-")[0].lower() in codes), lang)


def features(text: str) -> np.ndarray | None:
    """Hashed counts of two and three neighbouring characters of the words of a whole text.

    Letters are lower-cased, all else is one blank; roots of the counts, scaled to length 1.
    Nothing for a text without letters.
    """
    if not _LETTER.search(text):
        return None
    counts = np.zeros(DIMS, np.int64)
    for i in range(0, len(text), 1 << 20):  # pieces overlap by two, so every triple is met once
        codes = np.frombuffer(text[max(0, i - 2) : i + (1 << 20)].lower().encode("utf-32-le", "surrogatepass"), "<u4")
        letter = (codes >= 97) & (codes <= 122) | (codes >= 0xC0) & (codes != 0xD7) & (codes != 0xF7) & ~((codes >= 0x2000) & (codes <= 0x303F))
        x = np.where(letter, codes, np.uint32(32))
        pairs = (x[:-1] * np.uint32(2654435761) ^ x[1:] * np.uint32(2246822519))
        triples = pairs[:-1] * np.uint32(3266489917) ^ x[2:] * np.uint32(668265263)
        skip = 1 if i else 0
        counts[: DIMS // 2] += np.bincount((pairs[skip:] >> np.uint32(15)) % (DIMS // 2), minlength=DIMS // 2)
        counts[DIMS // 2 :] += np.bincount((triples >> np.uint32(15)) % (DIMS // 2), minlength=DIMS // 2)
    vector = np.sqrt(counts)
    return vector / max(np.sqrt((vector * vector).sum()), 1e-12)


@dataclass
class Model:
    """Family machines (one against the rest) and, per family, machines for each two of its languages."""

    families: list[str]
    languages: dict[str, list[str]]
    family_weights: np.ndarray  # families x (DIMS + 1)
    pairs: dict[str, list[tuple[int, int]]]
    pair_weights: dict[str, np.ndarray]

    def predict(self, rows: np.ndarray) -> tuple[list[str], list[float]]:
        """Language and score of feature rows: the best family, then most wins in it (margins on a tie)."""
        rows = np.c_[rows, np.ones(len(rows))]
        margins = rows @ self.family_weights.T
        best = margins.argmax(axis=1) if len(self.families) > 1 else np.zeros(len(rows), int)
        sure = _softmax(margins)[np.arange(len(rows)), best] if len(self.families) > 1 else np.ones(len(rows))
        langs, scores = np.empty(len(rows), object), np.zeros(len(rows))
        for f in np.unique(best):
            name, at = self.families[f], np.flatnonzero(best == f)
            members = self.languages[name]
            if len(members) == 1:
                langs[at], scores[at] = members[0], sure[at]
                continue
            duel = rows[at] @ self.pair_weights[name].T
            wins, total = np.zeros((len(at), len(members))), np.zeros((len(at), len(members)))
            for k, (i, j) in enumerate(self.pairs[name]):
                p = 1 / (1 + np.exp(-np.clip(4 * duel[:, k], -30, 30)))
                wins[:, i] += duel[:, k] >= 0
                wins[:, j] += duel[:, k] < 0
                total[:, i] += p
                total[:, j] += 1 - p
            won = (wins + total / (len(members) * 10)).argmax(axis=1)
            langs[at] = np.array(members, object)[won]
            scores[at] = sure[at] * total[np.arange(len(at)), won] / (len(members) - 1)
        return list(langs), np.clip(scores, 0, 1).tolist()


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(4 * (x - x.max(axis=1, keepdims=True)))
    return e / e.sum(axis=1, keepdims=True)


def _machine(x: np.ndarray, y: np.ndarray, rounds: int = 40, c: float = 10.0, seed: int = 7) -> np.ndarray:
    """A linear support vector machine by dual coordinate descent (squared hinge); y is +1 or -1.

    Both sides weigh the same, however many examples each has.
    """
    x = np.c_[x, np.ones(len(x))]
    cost = np.where(y > 0, c / max((y > 0).mean() * 2, 1e-9), c / max((y < 0).mean() * 2, 1e-9))
    diagonal = 0.5 / cost
    size = (x * x).sum(axis=1) + diagonal
    alpha, w = np.zeros(len(x)), np.zeros(x.shape[1])
    draw = np.random.default_rng(seed)
    for _ in range(rounds):
        moved = 0.0
        for i in draw.permutation(len(x)):
            gradient = y[i] * (x[i] @ w) - 1 + diagonal[i] * alpha[i]
            new = max(alpha[i] - gradient / size[i], 0.0)
            step = new - alpha[i]
            if step:
                w += step * y[i] * x[i]
                alpha[i] = new
                moved = max(moved, abs(step))
        if moved < 1e-3:
            break
    return w


def learn(docs: DataFrame, per_language: int = 400) -> Model | None:
    """A model from at most ``per_language`` whole training texts of each language.

    Rows are drawn by a hash of the id among the rows whose crc32 of the id leaves a
    remainder other than 0 by 5; null languages and texts without letters are not used. The
    sample is bounded for every language, so the drawn ids are broadcast and the machines
    are fitted in the driver; the feature rows come from tasks. All languages are kept and drawn in one pass. Nothing to learn
    from gives no model.
    """
    data = docs.where(in_training() & F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    # each task keeps the first rows of a language only, before any shuffle
    place = F.row_number().over(Window.partitionBy("lang").orderBy("h", "doc_id"))
    drawn = data.select("doc_id", "lang", F.xxhash64("doc_id").alias("h")).withColumn("place", place).where(F.col("place") <= per_language)
    ids = drawn.select(F.col("doc_id").alias("id"), F.col("lang").alias("known")).dropDuplicates(["id"])

    def featured(batches):
        for batch in batches:
            for lang, text in zip(batch.column("known").to_pylist(), batch.column("text").to_pylist()):
                vector = features(text)
                if vector is not None:
                    yield pa.RecordBatch.from_arrays([pa.array([lang]), pa.array([vector.astype(np.float32).tobytes()])], names=["lang", "x"])

    rows = data.select("doc_id", F.col("text").cast("string").alias("text")).join(F.broadcast(ids), F.col("doc_id") == F.col("id"))
    rows = rows.select("known", "text").mapInArrow(featured, "lang string, x binary").toPandas().sort_values(["lang", "x"])
    if not len(rows):
        return None
    x = np.stack([np.frombuffer(v, np.float32) for v in rows["x"]]).astype(np.float64)
    langs = rows["lang"].to_numpy()
    languages: dict[str, list[str]] = {}
    for lang in sorted(set(langs)):
        languages.setdefault(family_of(lang), []).append(lang)
    families = sorted(languages)
    own = np.array([family_of(v) for v in langs])
    model = Model(families, languages, np.zeros((len(families), DIMS + 1)), {}, {})
    if len(families) > 1:
        for i, name in enumerate(families):
            model.family_weights[i] = _machine(x, np.where(own == name, 1.0, -1.0))
    for name, members in languages.items():
        model.pairs[name] = list(combinations(range(len(members)), 2))
        weights = []
        for i, j in model.pairs[name]:
            at = (langs == members[i]) | (langs == members[j])
            weights.append(_machine(x[at], np.where(langs[at] == members[i], 1.0, -1.0)))
        model.pair_weights[name] = np.array(weights)
    return model


def identify(docs: DataFrame, model: Model | None, text_col: str = "text") -> DataFrame:
    """Add ``lang_pred`` and ``score`` to every row of ``docs``, from its whole text alone.

    A null text or one without letters is ``und`` with score 0, and so is all without a
    model. Rows are independent, so there is no shuffle; the model (a few thousand numbers
    per language pair) travels once per worker. Columns of the input named like an added one
    are replaced.
    """
    rows = without(docs, "lang_pred", "score")
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def mapped(batches):
        model = shared.value
        for whole in batches:
            for i in range(0, whole.num_rows, 512):
                batch = whole.slice(i, 512)
                langs, scores, found, at = [UNKNOWN] * batch.num_rows, [0.0] * batch.num_rows, [], []
                for k, text in enumerate(batch.column(text_col)):
                    vector = features(text.as_py() or "") if model else None
                    if vector is not None:
                        found.append(vector)
                        at.append(k)
                if found:
                    for k, lang, score in zip(at, *model.predict(np.stack(found))):
                        langs[k], scores[k] = lang, score
                yield add_columns(batch, {"lang_pred": pa.array(langs, pa.string()), "score": pa.array(scores, pa.float64())})

    return rows.mapInArrow(mapped, T.StructType([*rows.schema, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]))


def op5_language_id(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return identify(docs.select("doc_id", "text"), learn(docs)).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
