"""Fill-in-middle: documents cut at unit boundaries, found eight bytes at a time in 64-bit words."""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import add_columns, blocks, table, without

_ONES, _HIGH = np.uint64(0x0101010101010101), np.uint64(0x8080808080808080)
_EIGHT, _SEVEN, _TOP = np.uint64(8), np.uint64(7), np.uint64(56)
ADDED = ("n", "form", "prefix_chars", "middle_chars", "output")


@dataclass(frozen=True)
class Sentinels:
    """Marks of the three parts. No mark may begin with the end of another, so that they can be told apart in any text."""

    prefix: str = "<P>"
    suffix: str = "<S>"
    middle: str = "<M>"

    def __post_init__(self):
        marks = self.all
        if not all(marks) or len(set(marks)) < 3:
            raise ValueError("three different marks are needed")
        for a in marks:
            for b in marks:
                if (a != b and a in b) or any(a.endswith(b[:i]) for i in range(1, len(b)) if a != b or i < len(a)):
                    raise ValueError(f"{a!r} and {b!r} overlap")

    @property
    def all(self) -> tuple[str, str, str]:
        return self.prefix, self.suffix, self.middle


def _byte_after(marks: np.ndarray) -> np.ndarray:
    """The marks of the byte that follows each byte (words are little-endian, nothing follows the last)."""
    out = marks >> _EIGHT
    out[:-1] |= marks[1:] << _TOP
    return out


class Words:
    """The bytes of some texts as 64-bit words, with a mark on the top bit of every byte that ends a unit.

    A unit is a run of A-Z and a-z, or one other code point. A byte ends one if no
    continuation byte follows and it is not a letter before a letter; the last byte of a
    text always does.
    """

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        padded = np.zeros((len(data) // 8 + 1) * 8, np.uint8)  # one byte at least after the last
        padded[: len(data)] = data
        words = padded.view("<u8")
        plain = (words | np.uint64(0x2020202020202020)) & ~_HIGH
        # no byte carries into the next: 0x7F + 0x1F stays below 0x100
        letter = (plain + np.uint64(0x1F) * _ONES) & ~(plain + np.uint64(0x05) * _ONES) & ~words & _HIGH
        continued = words & ~(words << np.uint64(1)) & _HIGH
        self.units = _HIGH & ~_byte_after(continued) & ~(letter & _byte_after(letter))
        last = offsets[1:][offsets[1:] > offsets[:-1]] - 1
        np.bitwise_or.at(self.units, last >> 3, np.uint64(0x80) << (_EIGHT * (last & 7).astype(np.uint64)))
        self.points = _HIGH & ~continued
        self.unit_sums, self.point_sums = _sums(self.units), _sums(self.points)

    def units_before(self, at: np.ndarray) -> np.ndarray:
        return _before(self.units, self.unit_sums, at)

    def points_before(self, at: np.ndarray) -> np.ndarray:
        return _before(self.points, self.point_sums, at)

    def after_unit(self, rank: np.ndarray) -> np.ndarray:
        """Byte offset behind the unit with this rank, counted from 1 over all texts.

        The word is searched in the cumulative counts. Inside it a multiplication leaves in
        each byte the number of marks up to there, and the bytes below the wanted number are counted.
        """
        word = np.searchsorted(self.unit_sums, rank, side="left") - 1
        wanted = (rank - self.unit_sums[word]).astype(np.uint64)
        upto = (self.units[word] >> _SEVEN) * _ONES
        reached = ((upto | _HIGH) - wanted * _ONES) & _HIGH
        return word * 8 + 8 - np.bitwise_count(reached) + 1


def _sums(marks: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(np.bitwise_count(marks), dtype=np.int64)])


def _before(marks: np.ndarray, sums: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Marks on bytes before ``at``."""
    word = at >> 3
    below = (np.uint64(1) << (_EIGHT * (at & 7).astype(np.uint64))) - np.uint64(1)
    return sums[word] + np.bitwise_count(marks[word] & below)


def _bytes_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of an array of strings and the offsets of its rows in them."""
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    if data is None or not offsets[-1]:
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def fill_in_middle(docs: DataFrame, seed: int = 1, changed: int = 90, suffix_first: int = 20, sentinels: Sentinels = Sentinels(),
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Add ``n``, ``form``, ``prefix_chars``, ``middle_chars`` and ``output`` to every row.

    A whole text of ``n`` units (see ``Words``) is cut at two places drawn from the SHA-256 of
    ``seed:id``, uniformly from 0 to n. ``changed`` of 100 texts are rearranged, of these
    ``suffix_first`` of 100 as ``spm`` (suffix, prefix, middle), the others as ``psm``
    (prefix, suffix, middle), each part behind its mark. Empty texts and texts that contain
    a mark are always ``plain``: the output is the text and the counts of code points are null.
    A null text counts as empty, a null id as an empty one. Rows are independent: repeated rows
    get the same answer, there is no shuffle, and a task holds one block of texts at a time.
    Texts are UTF-8. Columns of the input named like an added one are replaced.
    """
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit(""))).cast("binary"), 256)
    draws = F.transform(F.array(*[F.lit(1 + 8 * i) for i in range(4)]), lambda at: F.conv(F.substr(digest, at, F.lit(8)), 16, 10).cast("long"))
    rows = without(docs, *ADDED)
    kept = [f for f in rows.schema]
    data = docs.select(*[F.col(f"`{f.name}`") for f in kept], F.col(f"`{text_col}`").cast("string").alias("__text"), draws.alias("__draws"))
    marks = [m.encode() for m in sentinels.all]

    def mapped(batches):
        for batch in batches:
            for part in blocks(batch, "__text"):
                texts = part.column("__text")
                raw, at = _bytes_of(texts)
                draw = part.column("__draws").flatten().to_numpy(zero_copy_only=False).reshape(-1, 4)
                words = Words(raw, at)
                first = words.units_before(at)
                n = np.diff(first)
                near, far = np.sort(draw[:, :2] % (n + 1)[:, None], axis=1).T
                start = at[:-1]
                # without a unit in front, a part ends where the text starts
                cut, end = [np.where(k > 0, words.after_unit(np.maximum(first[:-1] + k, 1)), start) if len(raw) else start for k in (near, far)]
                plain = (n == 0) | (draw[:, 2] % 100 >= changed)
                for mark in sentinels.all:
                    plain |= pc.fill_null(pc.match_substring(texts, mark), False).to_numpy(zero_copy_only=False)
                spm = ~plain & (draw[:, 3] % 100 < suffix_first)
                points = [words.points_before(x) for x in (start, cut, end)]
                whole, out = raw.tobytes(), []
                for a, b, c, d, is_plain, is_spm in zip(*[x.tolist() for x in (start, cut, end, at[1:], plain, spm)]):
                    if is_plain:
                        out.append(whole[a:d])
                    elif is_spm:
                        out.append(b"".join((marks[1], whole[c:d], marks[0], whole[a:b], marks[2], whole[b:c])))
                    else:
                        out.append(b"".join((marks[0], whole[a:b], marks[1], whole[c:d], marks[2], whole[b:c])))
                yield add_columns(part.select([f.name for f in kept]), {
                    "n": pa.array(n), "form": pa.array(np.select([plain, spm], ["plain", "spm"], "psm"), pa.string()),
                    "prefix_chars": pa.array(points[1] - points[0], mask=plain), "middle_chars": pa.array(points[2] - points[1], mask=plain),
                    "output": pa.array(out, pa.binary()).cast(pa.string())})

    added = [T.StructField("n", T.LongType()), T.StructField("form", T.StringType()), T.StructField("prefix_chars", T.LongType()),
             T.StructField("middle_chars", T.LongType()), T.StructField("output", T.StringType())]
    return data.mapInArrow(mapped, T.StructType([*kept, *added]))


def restored(output: Column, form: Column, sentinels: Sentinels = Sentinels()) -> Column:
    """The text from the output and its form: the first of each mark ends the part before it."""
    p, s, m = [re.escape(x) for x in sentinels.all]
    back = {"psm": (f"(?s)^{p}(.*?){s}(.*?){m}(.*)$", "$1$3$2"), "spm": (f"(?s)^{s}(.*?){p}(.*?){m}(.*)$", "$2$3$1")}
    out = F.when(form == "plain", output)
    for name, (pattern, order) in back.items():
        out = out.when(form == name, F.regexp_replace(output, pattern, order))
    return out


def op13_fill_in_middle(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return fill_in_middle(docs).select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
        F.sha2(restored(F.col("output"), F.col("form")).cast("binary"), 256).alias("restored_sha256"))


OP13_SQL = r"""
WITH cut AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS units,
         sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS h
  FROM documents
), drawn AS (
  SELECT doc_id, text, units, len(units) AS n, list_transform([1, 9, 17, 25], lambda i: ('0x' || substr(h, i, 8))::BIGINT) AS h FROM cut
), parts AS (
  SELECT doc_id, text, n, h, least(h[1] % (n + 1), h[2] % (n + 1)) AS a, greatest(h[1] % (n + 1), h[2] % (n + 1)) AS b,
         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h[3] % 100 >= 90 THEN 'plain'
              WHEN h[4] % 100 < 20 THEN 'spm' ELSE 'psm' END AS form, units
  FROM drawn
), joined AS (
  SELECT doc_id, text, n, form, array_to_string(units[1:a], '') AS p, array_to_string(units[a + 1:b], '') AS m, array_to_string(units[b + 1:n], '') AS s
  FROM parts
)
SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM joined
"""
