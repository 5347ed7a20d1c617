"""Fill-in-middle against a slow reading of the contract; round trip; awkward input."""

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from cubeloom.llm import fill_in_middle as fim

UNIT = re.compile(r"[A-Za-z]+|[^A-Za-z]", re.S)
AWKWARD = [None, "", "a", "Z", "@[`{", "ab", "a1b", "é", "日本語", "😀a😀", "\n\n", "ab cd\x00ef", "x<P>y", "<M>", "a<S", "́", "zz" * 40_000, "é" * 9_000, "abcdefgh", "abcdefg ", "abcdefghi"]


def slow(doc_id, text, seed=1, changed=90, spm=20):
    text = text or ""
    units = UNIT.findall(text)
    h = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(h[8 * i:8 * i + 8], 16) for i in range(4)]
    a, b = sorted((h[0] % (len(units) + 1), h[1] % (len(units) + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= changed:
        return len(units), "plain", None, None, text
    if h[3] % 100 < spm:
        return len(units), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return len(units), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def texts(count=400):
    rng = random.Random(3)
    letters = "aZqm AB19.,\n\té日😀@[`{<>"
    return AWKWARD + ["".join(rng.choice(letters) for _ in range(rng.randrange(60))) for _ in range(count)]


@pytest.mark.parametrize("partitions", [1, 5])
def test_against_brute_force_and_round_trip(spark, partitions):
    rows = [(i, t) for i, t in enumerate(texts())] + [(None, "no id here"), (7, "same id"), (7, "same id"), (-3, "negative id 12")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(partitions)
    out = fim.fill_in_middle(df).withColumn("back", fim.restored(F.col("output"), F.col("form"))).collect()
    assert len(out) == len(rows)
    for r in out:
        assert (r["n"], r["form"], r["prefix_chars"], r["middle_chars"], r["output"]) == slow(r["doc_id"], r["text"]), r["text"]
        assert r["back"] == (r["text"] or "")
    assert {r["form"] for r in out} == {"plain", "psm", "spm"}


def test_blocks_are_cut_by_bytes(spark, monkeypatch):
    import pyarrow as pa

    batch = pa.RecordBatch.from_pydict({"t": pa.array(["a" * 10, None, "b" * 25, "", "c" * 100, "d"], pa.string())})
    assert [b.num_rows for b in fim.blocks(batch, "t", 30)] == [2, 2, 1, 1]
    assert not list(fim.blocks(batch.slice(0, 0), "t", 30))


def test_words_find_every_unit_end():
    rng = random.Random(9)
    parts = [t or "" for t in texts(200)]
    rng.shuffle(parts)
    raw = [t.encode() for t in parts]
    offsets = np.concatenate([[0], np.cumsum([len(r) for r in raw])])
    words = fim.Words(np.frombuffer(b"".join(raw), np.uint8), offsets)
    ends = np.cumsum([len(u.encode()) for t in parts for u in UNIT.findall(t)])
    assert (words.after_unit(np.arange(1, len(ends) + 1)) == ends).all()
    assert (np.diff(words.units_before(offsets)) == [len(UNIT.findall(t)) for t in parts]).all()
    assert (np.diff(words.points_before(offsets)) == [len(t) for t in parts]).all()


def test_other_marks_and_shares(spark):
    marks = fim.Sentinels("<|prefix|>", "<|suffix|>", "<|middle|>")
    df = spark.createDataFrame([(i, f"line {i} of (text) $1") for i in range(60)], "doc_id long, text string")
    out = fim.fill_in_middle(df, changed=100, suffix_first=50, sentinels=marks).withColumn("back", fim.restored(F.col("output"), F.col("form"), marks)).collect()
    assert all(r["back"] == r["text"] for r in out) and {r["form"] for r in out} == {"psm", "spm"}
    for bad in (("a", "a", "b"), ("", "b", "c"), ("aXa", "b", "c"), ("ab", "bc", "d"), ("abc", "b", "d")):
        with pytest.raises(ValueError):
            fim.Sentinels(*bad)


def test_empty_table_and_clashing_columns(spark):
    df = spark.createDataFrame([(1, "some text here", "x", 3)], "doc_id long, text string, N string, output int")
    out = fim.fill_in_middle(df)
    assert out.columns == ["doc_id", "text", *fim.ADDED] and out.count() == 1
    assert fim.fill_in_middle(df.where("false")).count() == 0
    assert fim.fill_in_middle(df.select("doc_id", F.lit(None).cast("string").alias("text"))).first()["form"] == "plain"
