"""Byte-level BPE: encoding by a lazily determinised transducer, decoding by an incremental one."""

from __future__ import annotations

import base64
import codecs
import struct
from collections.abc import Iterable, Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import add_columns, table, without

VOCABULARY = "byte_bpe_50k.tiktoken"
MOST_STATES = 200_000  # states and cached pieces of one worker; beyond, the cache starts anew
MOST_PIECES = 250_000
WINDOW = 1024  # bytes of a long piece between two emissions


def read_ranks(raw: bytes) -> dict[bytes, int]:
    """Token bytes and their rank, from the lines of a rank file."""
    return {base64.b64decode(a): int(b) for a, b in (line.split() for line in raw.splitlines() if line)}


class Transducer:
    """Bytes in, token ids out, as a subsequential transducer built state by state.

    A piece has one encoding, and so has each of its prefixes: the only sequence of tokens
    in which no two neighbours would be merged otherwise. So a reader of bytes needs no
    search: it follows, for every prefix that the token being read may have started behind,
    the last token before it and the place in the trie of all tokens. That set of
    (last token, trie node) is a state. A step feeds one byte to every member, drops those
    that leave the trie, and adds the one member for the prefix that ends here: its output
    is the token that ends the encoding of that prefix. No member is older than the longest
    token, so what lies before the oldest one is settled: after a lookahead of that bounded
    length the tokens up to there are emitted, read off backwards from token to token.
    States and steps are made when a text first needs them and then kept; tokens that no
    following token can tell apart share a state.

    Two neighbours fit if merging their joint bytes by rank never joins across their border.
    Inside, each is merged as it would be alone, so the parts at the border and the ranks
    at which they come and go are known per token; a rank that joins two such parts while
    both are there is a misfit. Where the ranks of a token's merges do not rise (which
    trained merges do), the two are merged outright.
    """

    def __init__(self, ranks: dict[bytes, int], most_states: int = MOST_STATES):
        self.ranks = ranks
        self.token = {r: t for t, r in ranks.items()}
        self.most_states = most_states
        self.child: dict[int, int] = {}  # trie node << 8 | byte
        self.ends: list[int] = [-1]  # token that ends at a node
        self.depth: list[int] = [0]
        for token, rank in ranks.items():
            node = 0
            for byte in token:
                key = node << 8 | byte
                if key not in self.child:
                    self.child[key] = len(self.ends)
                    self.ends.append(-1)
                    self.depth.append(self.depth[node] + 1)
                node = self.child[key]
            self.ends[node] = rank
        self.fit: dict[int, bool] = {}
        self.edges: dict[int, tuple[list, list] | None] = {}
        self.inner = {key >> 8 for key in self.child}  # nodes that a longer token passes
        self.starts = {token[:i] for token in ranks for i in range(1, len(token))}
        self.alike: dict[int, int] = {}
        self.classes: dict[object, int] = {}
        self.width = {rank: len(token) for token, rank in ranks.items()}
        self._clear()

    def _clear(self) -> None:
        self.members = [((-1, 0),)]
        self.number = {self.members[0]: 0}
        self.steps: dict[int, int] = {}  # state << 8 | byte -> next state << 20 | token

    def merges(self, piece: bytes) -> Iterator[tuple[int, list[bytes]]]:
        """The ranks at which a short piece is merged, lowest first and leftmost on a tie, and its parts then."""
        ranks, parts = self.ranks, [piece[i : i + 1] for i in range(len(piece))]
        yield -1, parts
        while len(parts) > 1:
            found = [ranks.get(a + b, 1 << 60) for a, b in zip(parts, parts[1:])]
            rank = min(found)
            if rank == 1 << 60:
                return
            i = found.index(rank)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
            yield rank, parts

    def merged(self, piece: bytes) -> list[int]:
        for _, parts in self.merges(piece):
            pass
        return [self.ranks[p] for p in parts]

    def borders(self, token: int) -> tuple[list, list] | None:
        """Parts at the left and right border of a token as ``(from rank, to rank, part)``; nothing if ranks fall."""
        if token in self.edges:
            return self.edges[token]
        left, right, before, out = [], [], -1, None
        for rank, parts in self.merges(self.token[token]):
            if rank < before:
                break
            for side, part in ((left, parts[0]), (right, parts[-1])):
                if not side or side[-1][2] != part:
                    if side:
                        side[-1] = (side[-1][0], rank, side[-1][2])
                    side.append((rank, 1 << 60, part))
            before = rank
        else:
            out = (left, right) if len(parts) == 1 else None
        self.edges[token] = out
        return out

    def fits(self, before: int, token: int) -> bool:
        key = before + 1 << 20 | token
        known = self.fit.get(key)
        if known is not None:
            return known
        if before < 0:
            known = self.merged(self.token[token]) == [token]
        else:
            x, y = self.borders(before), self.borders(token)
            if x is None or y is None:
                known = self.merged(self.token[before] + self.token[token]) == [before, token]
            else:
                known, rank_of = True, self.ranks.get
                for x_from, x_to, right in x[1]:
                    for y_from, y_to, left in y[0]:
                        if y_from < x_to and x_from <= y_to:
                            rank = rank_of(right + left)
                            if rank is not None and rank < x_to and rank <= y_to:
                                known = False
        if len(self.fit) >= 2 * self.most_states:
            self.fit.clear()
        self.fit[key] = known
        return known

    def _alike(self, token: int) -> int:
        """A token that stands for all that fit the same followers.

        A part at the right border matters only if some token starts with it and goes on.
        """
        found = self.alike.get(token)
        if found is None:
            borders = self.borders(token)
            key = token if borders is None else tuple(x for x in borders[1] if x[2] in self.starts)
            found = self.alike[token] = self.classes.setdefault(key, token)
        return found

    def _step(self, state: int, byte: int) -> int:
        after, ends, child = [], self.ends, self.child
        new = -1
        for last, node in self.members[state]:
            node = child.get(node << 8 | byte)
            if node is None:
                continue
            if new < 0 and ends[node] >= 0 and self.fits(last, ends[node]):
                new = ends[node]
            if node in self.inner:
                after.append((last, node))
        after.append((self._alike(new), 0))  # members stay in order of their start
        members = tuple(after)
        found = self.number.get(members)
        if found is None:
            found = self.number[members] = len(self.members)
            self.members.append(members)
        self.steps[state << 8 | byte] = step = found << 20 | new
        return step

    def encode(self, piece: bytes) -> list[int]:
        """Ids of one piece; a piece that is a token is that token."""
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        if len(self.members) > self.most_states:
            self._clear()
        state, last, steps = 0, [], self.steps
        ids: list[int] = []
        limit = WINDOW
        for byte in piece:
            step = steps.get(state << 8 | byte)
            if step is None:
                step = self._step(state, byte)
            state = step >> 20
            last.append(step & 0xFFFFF)
            if len(last) >= limit:
                ids += self._settled(last, [len(last) - self.depth[node] for _, node in self.members[state]])
                limit = len(last) + WINDOW
        return ids + [token for _, token in self._path(last, len(last))]

    def _path(self, last: list[int], end: int) -> list[tuple[int, int]]:
        """Where the tokens of the prefix up to ``end`` end, and their ids, in order."""
        width, way = self.width, []
        while end > 0:
            way.append((end, last[end - 1]))
            end -= width[last[end - 1]]
        way.reverse()
        return way

    def _settled(self, last: list[int], starts: list[int]) -> list[int]:
        """Ids that the prefixes of all members begin with; ``last`` keeps what is open."""
        ways = [self._path(last, start) for start in starts]
        shared = 0
        while all(len(w) > shared and w[shared] == ways[0][shared] for w in ways):
            shared += 1
        if shared:
            del last[: ways[0][shared - 1][0]]
        return [token for _, token in ways[0][:shared]]


class Codec:
    """Whole texts to packed ids and back."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.token = {r: t for t, r in ranks.items()}
        self.ranks, self.built = ranks, None
        self.pieces = regex.compile(pattern)
        self.cache: dict[str, bytes] = {}

    @property
    def machine(self) -> Transducer:
        if self.built is None:  # decoding needs none
            self.built = Transducer(self.ranks)
        return self.built

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers; pieces seen before are looked up."""
        cache, out = self.cache, []
        for piece in self.pieces.findall(text):
            ids = cache.get(piece)
            if ids is None:
                if len(cache) >= MOST_PIECES:
                    cache.clear()
                found = self.machine.encode(piece.encode("utf-8", "surrogatepass"))
                ids = struct.pack(f"<{len(found)}I", *found)
                if len(piece) < 64:
                    cache[piece] = ids
            out.append(ids)
        return b"".join(out)

    def bytes_of(self, ids: bytes) -> bytes:
        return b"".join(map(self.token.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def stream_text(chunks: Iterable[bytes]) -> Iterator[str]:
    """Text of byte chunks that may end inside a character.

    The decoder keeps the state of an unfinished UTF-8 sequence between chunks; bytes that
    form none become U+FFFD.
    """
    state = codecs.getincrementaldecoder("utf-8")("replace")
    for chunk in chunks:
        if text := state.decode(chunk):
            yield text
    if text := state.decode(b"", True):
        yield text


_codecs: dict[tuple[bytes, str], Codec] = {}  # of this worker; one vocabulary as a rule


def _codec(raw: bytes, pattern: str) -> Codec:
    if (raw, pattern) not in _codecs:
        _codecs.clear()
        _codecs[raw, pattern] = Codec(read_ranks(raw), pattern)
    return _codecs[raw, pattern]


def _vocabulary(docs: DataFrame, path: str | None):
    """The rank file, sent to every worker once; its size does not depend on the data."""
    with open(path or public_tokenizers.path(VOCABULARY), "rb") as file:
        return docs.sparkSession.sparkContext.broadcast(file.read())


def _mapped(docs: DataFrame, added: dict[str, T.DataType], code, path: str | None, pattern: str) -> DataFrame:
    """``docs`` with the columns that ``code(codec, batch)`` makes in place of those of the same name."""
    rows, shared = without(docs, *added), _vocabulary(docs, path)

    def mapped(batches):
        codec = _codec(shared.value, pattern)
        for batch in batches:
            for i in range(0, batch.num_rows, 1000):
                part = batch.slice(i, 1000)
                yield add_columns(part.select(names), dict(zip(added, code(codec, part))))

    names = rows.columns
    return docs.mapInArrow(mapped, T.StructType([*rows.schema, *[T.StructField(k, v) for k, v in added.items()]]))


def _encoded(codec: Codec, texts: pa.Array) -> tuple[pa.Array, pa.Array]:
    ids = [codec.encode(t.as_py() or "") for t in texts]
    return pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(ids, pa.binary())


def _decoded(codec: Codec, packed: pa.Array, chunk: int) -> pa.Array:
    texts = []
    for ids in packed:
        ids = ids.as_py() or b""
        texts.append("".join(stream_text(codec.bytes_of(ids[i : i + 4 * chunk]) for i in range(0, len(ids), 4 * chunk))))
    return pa.array(texts, pa.string())


CHUNK = 4096  # tokens that the decoder takes at a time


def encode_documents(docs: DataFrame, path: str | None = None, pattern: str = public_tokenizers.PATTERN,
                     text_col: str = "text") -> DataFrame:
    """Add ``n_tokens`` and ``ids`` (packed little-endian unsigned 32-bit integers) to ``docs``.

    Each match of ``pattern`` is encoded by itself, without special tokens. A null or empty
    text has no ids. Rows are independent: no shuffle, and repeats cost a look-up. Columns of
    the input named like an added one are replaced, in all three functions.
    """
    return _mapped(docs, {"n_tokens": T.LongType(), "ids": T.BinaryType()},
                   lambda codec, batch: _encoded(codec, batch.column(text_col)), path, pattern)


def decode_documents(encoded: DataFrame, path: str | None = None, pattern: str = public_tokenizers.PATTERN) -> DataFrame:
    """Add ``decoded``, the text of ``ids``; null ids give ""."""
    return _mapped(encoded, {"decoded": T.StringType()}, lambda codec, batch: (_decoded(codec, batch.column("ids"), CHUNK),), path, pattern)


def round_trip_documents(docs: DataFrame, path: str | None = None, pattern: str = public_tokenizers.PATTERN,
                         text_col: str = "text") -> DataFrame:
    """Encode and then decode the ids, in one pass: adds ``n_tokens``, ``ids`` and ``decoded``."""

    def code(codec, batch):
        n, ids = _encoded(codec, batch.column(text_col))
        return n, ids, _decoded(codec, ids, CHUNK)

    return _mapped(docs, {"n_tokens": T.LongType(), "ids": T.BinaryType(), "decoded": T.StringType()}, code, path, pattern)


def op10_byte_bpe(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return round_trip_documents(docs).select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))
