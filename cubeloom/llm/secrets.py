"""Secret scans: base patterns, and a linear-chain conditional random field that adds spans."""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import add_columns, table, text_blocks, without

# fixed values: the base patterns and their kinds, in order
KINDS = ("assign", "access", "hex", "crf")
_ASSIGN = re.compile(r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{16,}")  # a run of 16 or more is the whole run: it starts at its first and takes all
_CHUNK = re.compile(r"[^\s\"'`<>(){}\[\],;]{8,}")
_TOKEN = re.compile(r"[A-Za-z0-9+/_-]+|[^A-Za-z0-9+/_-]")
_KEY_PART = re.compile(r"[a-z]{3,}")
DIMS = 1 << 15  # hashed features
OUTSIDE, BEGIN, INSIDE = range(3)
# fixed values: words before a secret that the base patterns do not list; they teach in place of those listed
ANNOUNCED = ("bearer", "basic", "pass:", "pwd:", "auth:", "credential:", "private_key:", "auth_key:")
LEAST = 8  # characters of a span that the chain may add
PLAIN = 8  # one in so many stretches without digit and secret teaches, with that weight
KEPT = 20_000  # entries of a cache of scores


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Spans of the base patterns, leftmost and non-overlapping per kind; matches that are too short are dropped."""
    out = []
    if ":" in text or "=" in text:
        out += [("assign", m.start(), m.end()) for m in _ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 12]
    if "AKIA" in text:
        out += [("access", m.start(), m.end()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 18]
    out += [("hex", m.start(), m.end()) for m in _HEX.finditer(text)]
    return sorted(out, key=_order)


def _order(span: tuple[str, int, int]):
    return span[1], KINDS.index(span[0]), span[2]


def shape(token: str) -> str:
    """Runs of upper, lower, digit and other characters, one letter each (at most six)."""
    if token.isascii():
        if token.islower() and token.isalpha():
            return "a"
        if token.isdigit():
            return "9"
        if token.istitle() and token.isalpha() and len(token) > 1:
            return "Aa"
    return re.sub(r"(.)\1+", r"\1", re.sub(r"[^Aa9]", ".", re.sub(r"[0-9]", "9", re.sub(r"[a-z]", "a", re.sub(r"[A-Z]", "A", token)))))[:6]


def chunks(text: str) -> list[tuple[int, int]]:
    """Stretches without blanks, quotes or brackets that may hold a secret: all of 8 characters at least, each a chain of its own."""
    return [m.span() for m in _CHUNK.finditer(text)]


def file_features(text: str) -> list[str]:
    """What the whole text looks like: share of assignment signs, of digits, and length."""
    n = max(len(text), 1)
    signs, digits = text.count("=") + text.count(":"), sum(text.count(d) for d in "0123456789")
    return [f"fs{min(5, int(math.log2(1 + 1000 * signs / n)))}", f"fd{min(5, int(math.log2(1 + 1000 * digits / n)))}", f"fl{min(6, len(str(n)))}"]


def _hash(name: str) -> int:
    return zlib.crc32(name.encode("utf-8", "surrogatepass")) % DIMS


def _hashed(names: list[str]) -> list[int]:
    return [_hash(name) for name in names]


_SIZES = [f"n{n if n < 8 else 8 + min(n // 4, 12)}" for n in range(64)]


def _size(token: str) -> str:
    n = len(token)
    return _SIZES[n] if n < 64 else _SIZES[63]


def _mix(token: str) -> str:
    if token.isascii() and token.isalpha():
        return "l" if token.islower() else "u" if token.isupper() else "lu"
    return "".join(k for k, test in (("d", str.isdigit), ("l", str.islower), ("u", str.isupper)) if any(map(test, token)))


def _look(token: str) -> tuple[str, str, str, int, bool]:
    """Shape, mix of characters, size, how many different characters, and whether all are hexadecimal digits."""
    return shape(token), _mix(token), _size(token), min(len(set(token)), 24), not token.strip("0123456789abcdef")


# Each feature depends on one part of what surrounds a token, so that its weights can be summed once for all tokens with that part.


def _of_look(key: tuple) -> list[int]:
    (form, kinds, size, different, hexes), last_shape = key
    return _hashed(["b", f"s{form}", size, f"k{kinds}", f"e{different}", f"x{hexes}", f"k{kinds}{size}", f"z{last_shape}|{form}"])


def _of_file(key: tuple[tuple[str, ...], str]) -> list[int]:
    file, kinds = key
    return _hashed([*file, *[f"{f}{kinds}" for f in file]])


def _of_beginning(beginning: str) -> list[int]:
    return _hashed([f"p{beginning}"])


def _of_neighbours(key: tuple[str, str]) -> list[int]:
    last, following = key
    part = _KEY_PART.findall(last.lower())[-1:] if len(last) < 24 else []
    return _hashed([f"l{last.lower()[:12] if len(last) < 12 else shape(last)}", f"y{''.join(part)[:4]}",
                    f"r{following if len(following) == 1 else shape(following)}"])


def _word_part(before: str) -> str:
    part = before if before.isascii() and before.isalpha() and len(before) > 2 else "".join(_KEY_PART.findall(before)[-1:])
    return f"v{part[:4]}{before[-1:] if before[-1:] in ':=' else ''}"


def _of_words(key: tuple[str, str]) -> list[int]:
    before, size = key
    return _hashed([f"w{before}", f"w{before}{size}", _word_part(before)])


PARTS = (_of_look, _of_file, _of_beginning, _of_neighbours, _of_words)  # of a token, in the order of ``_keys``


def _keys(last: str, token: str, following: str, before: str, file: tuple[str, ...], look: tuple, last_shape: str):
    """What each of ``PARTS`` depends on."""
    return (look, last_shape), (file, look[1]), token[:4], (last[:24], following[:24]), (before, look[2])


def token_features(text: str, spans: list[tuple[int, int]], before: str, file: list[str]) -> list[list[int]]:
    """Hashed features of the tokens of a stretch: shape, size, mix of characters, neighbours, and the file's."""
    tokens = ["^", *[text[a:b] for a, b in spans], "$"]
    out = []
    for last, token, following in zip(tokens, tokens[1:], tokens[2:]):
        keys = _keys(last, token, following, before, tuple(file), _look(token), shape(last))
        out.append([x for part, key in zip(PARTS, keys) for x in part(key)])
    return out


def _tokens(text: str, start: int, end: int, chunk: str) -> list[tuple[int, int]]:
    if chunk.isascii():
        if chunk.isalnum():
            return [(start, end)]
        if chunk[-1] in ".:!?" and chunk[:-1].isalnum():
            return [(start, end - 1), (end - 1, end)]
    return [m.span() for m in _TOKEN.finditer(text, start, end)]


def _words_before(text: str, start: int) -> str:
    words = text[max(0, start - 40) : start].rsplit(None, 2)
    return (" ".join(words[-2:]) if words and len(words[-1]) < 3 else words[-1] if words else "").lower().strip("\"'")[-24:]


def _stretches(text: str):
    """``(token spans, words before, file features)`` of every stretch of a text."""
    file = None
    for match in _CHUNK.finditer(text):
        start, end = match.span()
        file = file or file_features(text)
        yield _tokens(text, start, end, match.group()), _words_before(text, start), file


def stretches(text: str):
    """``(token spans, features)`` of every stretch of a text."""
    for spans, before, file in _stretches(text):
        yield spans, token_features(text, spans, before, file)


@dataclass
class Model:
    emit: np.ndarray  # DIMS x 3
    move: np.ndarray  # 3 x 3, from row to column
    start: np.ndarray  # 3

    known: list = field(default_factory=list, repr=False, compare=False)  # summed weights by look and by neighbours, looks of tokens, all weights, settled stretches by file, and the gains

    def viterbi(self, features: list[list[int]]) -> list[int]:
        """The best tags of a chain; inside follows begin or inside only."""
        return self._best([self.emit[f].sum(axis=0).tolist() for f in features])

    def tags(self, text: str, spans: list[tuple[int, int]], before: str, file: list[str]) -> list[int]:
        """``viterbi`` of a stretch. A chain in which no token can gain by leaving outside is outside without a search."""
        scores = self.scores(text, spans, before, file)
        return [OUTSIDE] * len(spans) if self.quiet(scores) else self._best(scores)

    def scores(self, text: str, spans: list[tuple[int, int]], before: str, file: list[str]) -> list[list[float]]:
        """Scores of the three tags per token."""
        return self.told(before, *self.own(text, spans, tuple(file)))

    def own(self, text: str, spans: list[tuple[int, int]], file: tuple[str, ...]) -> tuple[list[tuple[float, float, float]], list[str]]:
        """Scores without the words before, and the sizes of the tokens; what each part adds is summed once and remembered, as most parts recur."""
        if not self.known:
            self.known = [{}, {}, {}, [tuple(row) for row in self.emit.tolist()], {}, *self._gains()]
        by_look, by_neighbours, looks, weights = self.known[:4]
        out, sizes, last, last_shape, kinds, following = [], [], "^", ".", None, text[spans[0][0] : spans[0][1]]
        for i in range(1, len(spans) + 1):
            token = following
            following = text[spans[i][0] : spans[i][1]] if i < len(spans) else "$"
            look = looks.get(token)
            if look is None:
                look = _look(token)
                if len(token) <= 4:  # longer ones seldom recur
                    _keep(looks, token, look)
            key = look, last_shape
            seen = by_look.get(key) or self._sum(by_look, _of_look, key)
            if look[1] != kinds:
                kinds = look[1]
                key = file, kinds
                whole = by_look.get(key) or self._sum(by_look, _of_file, key)
            key = last[:24], following[:24]
            near = by_neighbours.get(key) or self._sum(by_neighbours, _of_neighbours, key)
            begin = weights[_hash("p" + token[:4])]
            out.append((seen[0] + whole[0] + near[0] + begin[0], seen[1] + whole[1] + near[1] + begin[1], seen[2] + whole[2] + near[2] + begin[2]))
            sizes.append(look[2])
            last, last_shape = token, look[0]
        return out, sizes

    def told(self, before: str, own: list[tuple[float, float, float]], sizes: list[str]) -> list[list[float]]:
        """Scores with the words before: two features hold for the whole stretch, one changes with the size of the token."""
        weights = self.known[3]
        words, part = weights[_hash(f"w{before}")], weights[_hash(_word_part(before))]
        out = []
        for (a, b, c), size in zip(own, sizes):
            sized = weights[_hash(f"w{before}{size}")]
            out.append([a + sized[0] + words[0] + part[0], b + sized[1] + words[1] + part[1], c + sized[2] + words[2] + part[2]])
        return out

    def _sum(self, known: dict, part, key) -> tuple[float, float, float]:
        rows = [self.known[3][f] for f in part(key)]
        row = sum(r[0] for r in rows), sum(r[1] for r in rows), sum(r[2] for r in rows)
        _keep(known, key, row)
        return row

    def _gains(self) -> tuple[float, float, float, float]:
        """The most that begin and inside can add to a chain that stays outside, both moves included; then the same with any words before."""
        move, stay = self.move.tolist(), float(self.move[OUTSIDE, OUTSIDE])
        back = max(0.0, move[BEGIN][OUTSIDE] - stay, move[INSIDE][OUTSIDE] - stay)
        gains = [back + max(max(move[a][tag] for a in range(3)) - stay, float(self.start[tag] - self.start[OUTSIDE])) for tag in (BEGIN, INSIDE)]
        words = [3 * max(0.0, float((self.emit[:, tag] - self.emit[:, OUTSIDE]).max())) for tag in (BEGIN, INSIDE)]
        return (*gains, gains[0] + words[0], gains[1] + words[1])

    def quiet(self, scores: list[list[float]]) -> bool:
        """Proof that all outside is the best chain: each token with another tag costs more than its tag and both its moves can add."""
        begin, inside = self.known[5:7]
        return all(b - a + begin < 0 and c - a + inside < 0 for a, b, c in scores)

    def always_quiet(self, own: list[tuple[float, float, float]]) -> bool:
        """The same whatever words stand before, from the heaviest weights there are."""
        begin, inside = self.known[7:9]
        return all(b - a + begin < 0 and c - a + inside < 0 for a, b, c in own)

    def settled(self, file: tuple[str, ...]) -> dict[str, bool]:
        """Stretches known to be quiet in files that look like this, whatever stands before them."""
        by_file = self.known[4]
        return by_file.setdefault(file, {})

    def _best(self, scores: list[list[float]]) -> list[int]:
        move, start = self.move.tolist(), self.start.tolist()
        best, back = [s + t for s, t in zip(scores[0], start)], []
        for row in scores[1:]:
            ways = [max(OUTSIDE, BEGIN, INSIDE, key=lambda a: best[a] + move[a][b]) for b in (OUTSIDE, BEGIN, INSIDE)]
            back.append(ways)
            best = [best[a] + move[a][b] + row[b] for b, a in enumerate(ways)]
        tags = [max(OUTSIDE, BEGIN, INSIDE, key=best.__getitem__)]
        for ways in reversed(back):
            tags.append(ways[tags[-1]])
        return tags[::-1]


def _keep(known: dict, key, value) -> None:
    if len(known) >= KEPT:
        known.clear()
    known[key] = value


BARRED = -1e4


def found_spans(text: str, model: Model | None) -> list[tuple[str, int, int]]:
    """Spans that the chain tags, joined from their begin and inside tokens; those within a base span add nothing and are left out."""
    if model is None:
        return []
    out, file, settled = [], None, {}
    for match in _CHUNK.finditer(text):
        chunk = match.group()
        if chunk in settled:
            continue
        start, end = match.span()
        spans = _tokens(text, start, end, chunk)
        file = file or tuple(file_features(text))
        own, sizes = model.own(text, spans, file)
        settled = settled or model.settled(file)
        if model.always_quiet(own):
            if len(chunk) <= 64:
                _keep(settled, chunk, True)
            continue
        scores = model.told(_words_before(text, start), own, sizes)
        if model.quiet(scores):
            continue
        open_at = None
        for (start, end), tag in zip([*spans, (-1, -1)], [*model._best(scores), OUTSIDE]):
            if tag != INSIDE and open_at is not None:
                out.append((open_at, stop))
                open_at = None
            if tag == BEGIN:
                open_at = start
            stop = end
    return [("crf", a, b) for a, b in _outside(out, base_spans(text)) if b - a >= LEAST]


def _outside(spans: list[tuple[int, int]], base: list[tuple[str, int, int]]) -> Iterator[tuple[int, int]]:
    """The spans that lie within no base span; both lists are in order of their starts."""
    i, reach = 0, -1
    for a, b in spans:
        while i < len(base) and base[i][1] <= a:
            reach = max(reach, base[i][2])
            i += 1
        if b > reach:
            yield a, b


def train(chains: list[tuple[np.ndarray, list[int], float]], rounds: int = 30, rate: float = 0.2, decay: float = 1e-4) -> Model:
    """Maximum likelihood of the tags of weighted chains by AdaGrad; forward and backward sums run over all chains of a length at once."""
    model = Model(np.zeros((DIMS, 3)), np.zeros((3, 3)), np.zeros(3))
    model.move[OUTSIDE, INSIDE] = model.start[INSIDE] = BARRED
    by_length: dict[tuple[int, int], list[int]] = {}
    for i, (features, _, _) in enumerate(chains):
        by_length.setdefault((len(features), len(features[0])), []).append(i)
    groups = []
    for members in by_length.values():
        for i in range(0, len(members), 512):
            part = members[i : i + 512]
            groups.append((np.array([chains[j][0] for j in part]), np.array([chains[j][1] for j in part]), np.array([chains[j][2] for j in part])))
    sums = [np.full_like(a, 1e-6) for a in (model.emit, model.move, model.start)]
    total = sum(w for _, _, w in chains)
    for _ in range(rounds):
        for f, y, weight in groups:
            (n, length, _), mass_of = f.shape, weight.sum()
            scores = model.emit[f].sum(axis=2)
            ahead = np.empty((n, length, 3))
            behind = np.zeros((n, length, 3))
            ahead[:, 0] = scores[:, 0] + model.start
            for t in range(1, length):
                ahead[:, t] = _logsum(ahead[:, t - 1, :, None] + model.move) + scores[:, t]
            for t in range(length - 2, -1, -1):
                behind[:, t] = _logsum((model.move + (scores[:, t + 1] + behind[:, t + 1])[:, None, :]).transpose(0, 2, 1))
            log_z = _logsum(ahead[:, -1, :, None])[:, 0]
            mass = np.exp(ahead + behind - log_z[:, None, None])
            error = (mass - np.eye(3)[y]) * weight[:, None, None]
            emit = np.zeros_like(model.emit)
            np.add.at(emit, f.reshape(-1), np.repeat(error.reshape(-1, 3), f.shape[2], axis=0))
            move = np.zeros((3, 3))
            for t in range(1, length):
                pair = np.exp(ahead[:, t - 1, :, None] + model.move + (scores[:, t] + behind[:, t])[:, None, :] - log_z[:, None, None])
                move += (pair * weight[:, None, None]).sum(axis=0)
                np.add.at(move, (y[:, t - 1], y[:, t]), -weight)
            start = error[:, 0].sum(axis=0)
            for value, gradient, square in zip((model.emit, model.move, model.start), (emit, move, start), sums):
                gradient = gradient / mass_of + decay * np.where(value > BARRED / 2, value, 0) * mass_of / total
                gradient = np.where(value > BARRED / 2, gradient, 0)
                square += gradient * gradient
                value -= rate * gradient / np.sqrt(square)
    return model


def _logsum(x: np.ndarray) -> np.ndarray:
    """log of the sum of exponentials over axis 1."""
    top = x.max(axis=1, keepdims=True)
    return np.log(np.exp(x - top).sum(axis=1)) + top[:, 0]


def _recast(text: str, secret: np.ndarray, letters: bool = False) -> str:
    """The text with other letters and digits (or letters alone) in its secrets, drawn from a hash of the text."""
    draw = np.random.default_rng(zlib.crc32(text.encode("utf-8", "surrogatepass")))
    alphabet = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    if letters:
        alphabet = alphabet[:52]
    chars = list(text)
    for i in np.flatnonzero(secret).tolist():
        if chars[i].isascii() and chars[i].isalnum():
            chars[i] = alphabet[draw.integers(len(alphabet))]
    return "".join(chars)


def learn(docs: DataFrame, with_secret: int = 1500, without_secret: int = 1500, longest: int = 20_000, text_col: str = "text") -> Model | None:
    """A chain fitted to what the base patterns tag, in a bounded sample of documents.

    Documents with a base span and documents with stretches but no base span, at most so
    many of each, are drawn by a hash of their text among those of up to ``longest`` code
    points. Inside an assignment the value is the secret. Numbers alone are no teachers:
    a stretch that is digits only is outside. Each secret teaches three times, the
    second time with its letters and digits drawn anew from all letters and digits, the
    third time from letters alone and behind other words, so that keys of other alphabets than those of the
    patterns are known too. Of the many stretches without digit and secret one in ``PLAIN``
    teaches, with that weight. Without a document with a secret there is no
    model, and only base spans are reported.
    """
    data = docs.select(F.col(text_col).cast("string").alias("text")).where(
        F.col("text").rlike(r"\S{8}") & (F.char_length("text") <= longest)).withColumn("h", F.xxhash64("text"))
    likely = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]|AKIA[A-Z0-9]{14}|(?-i)[0-9a-f]{16}"""
    # hashes are drawn first: only they are ordered, and the texts of the few drawn ones are fetched by a broadcast of them
    marked = data.select("h", F.col("text").rlike(likely).alias("y")).groupBy("h").agg(F.max("y").alias("y"))
    drawn = marked.where("y").orderBy("h").limit(with_secret).unionByName(marked.where("not y").orderBy("h").limit(without_secret))
    sample = data.join(F.broadcast(drawn.select("h")), "h").dropDuplicates(["h"])

    def chained(batches):
        for batch in text_blocks(batches, "text"):
            features, tags, weights = [], [], []
            for text in batch.column("text").to_pylist():
                secret = np.zeros(len(text) + 1, bool)
                for kind, a, b in base_spans(text):
                    if kind == "assign":
                        a = _ASSIGN.match(text, a).start(2)
                    if not text[a:b].isdigit():
                        secret[a:b] = True
                for turn, other in enumerate((text, _recast(text, secret), _recast(text, secret, True)) if secret.any() else (text,)):
                    for spans, before, file in _stretches(other):
                        own, last, weight = [], OUTSIDE, 1
                        for a, b in spans:
                            last = OUTSIDE if not secret[a:b].all() else BEGIN if last == OUTSIDE else INSIDE
                            own.append(last)
                        if not any(own):
                            chunk = other[spans[0][0] : spans[-1][1]]
                            if turn:  # told by the text itself
                                continue
                            if not any(c in chunk for c in "0123456789"):
                                weight = PLAIN
                                if zlib.crc32(f"{before} {chunk} {spans[0][0]}".encode("utf-8", "surrogatepass")) % PLAIN:
                                    continue
                        if turn == 2 and own[0] == BEGIN:
                            before = ANNOUNCED[zlib.crc32(other[spans[0][0] : spans[-1][1]].encode("utf-8", "surrogatepass")) % len(ANNOUNCED)]
                        features.append([x for row in token_features(other, spans, before, file) for x in row])
                        tags.append(own)
                        weights.append(weight)
            yield pa.RecordBatch.from_arrays(
                [pa.array(features, pa.list_(pa.int32())), pa.array(tags, pa.list_(pa.int32())), pa.array(weights, pa.int32())], names=["f", "y", "w"])

    chains = []
    for f, y, w in sample.select("text").mapInArrow(chained, "f array<int>, y array<int>, w int").toLocalIterator():
        f = np.array(f, np.int32).reshape(len(y), -1)
        for a, b in _teachable(y):
            chains.append((f[a:b], list(y[a:b]), float(w)))
    if not any(BEGIN in y for _, y, _ in chains):
        return None
    return train(chains)


def _teachable(tags: list[int], length: int = 64) -> Iterator[tuple[int, int]]:
    """A long chain teaches in parts of about ``length`` tokens, each cut where no secret goes on."""
    start = 0
    while start < len(tags):
        stop = min(start + length, len(tags))
        while stop < len(tags) and tags[stop] == INSIDE:
            stop += 1
        yield start, stop
        start = stop


def scan_secrets(docs: DataFrame, model: Model | None, text_col: str = "text") -> DataFrame:
    """Add ``spans`` to every row: ``kind, start, stop`` in code points, by start and then kind.

    Base spans are always there; the chain adds spans of kind ``crf`` that lie
    in none of them. Whole texts are read; a null or empty text has no spans. Rows are independent: no
    shuffle. A column of the input named like the added one is replaced.
    """
    rows = without(docs, "spans")
    names = rows.columns
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("stop", pa.int32())]))

    def mapped(batches):
        model = shared.value
        for batch in text_blocks(batches, text_col):
            out = []
            for text in batch.column(text_col):
                text = text.as_py() or ""
                found = base_spans(text) + found_spans(text, model)
                out.append([{"kind": k, "start": a, "stop": b} for k, a, b in sorted(found, key=_order)])
            yield add_columns(batch.select(names), {"spans": pa.array(out, kind)})

    added = T.ArrayType(T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.IntegerType()), T.StructField("stop", T.IntegerType())]))
    return docs.mapInArrow(mapped, T.StructType([*rows.schema, T.StructField("spans", added)]))


def _joined(spans):
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))), ",")


def _only(kind: str):
    return lambda k: F.when(k == kind, k)


def op3_secret_scan(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = scan_secrets(docs, learn(docs)).select("doc_id", "spans")
    base = F.filter("spans", lambda s: s["kind"] != "crf")
    kinds = F.transform("spans", lambda s: s["kind"])
    counts = [F.size(F.array_compact(F.transform(kinds, _only(k)))).cast("long").alias(f"n_{k}") for k in KINDS]
    return found.select("doc_id", *counts, F.sha2(_joined(base).cast("binary"), 256).alias("base_sha256"), _joined(F.col("spans")).alias("spans"))
