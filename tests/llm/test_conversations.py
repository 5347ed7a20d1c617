"""Conversation repair against a search over all edits; pieces of every size; awkward input."""

import hashlib
import random
import re
import zlib

import pytest

from cubeloom.llm import conversations as cv

NEXT = {"": {"s", "u"}, "s": {"u"}, "u": {"a"}, "a": {"u"}}  # what may follow the last initial


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        d = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if d == 0:
            continue
        text = "" if d == 1 else re.sub("[.!?]", "", text) if d == 2 else text
        out += [(conv, turn, "user" if d == 4 else role, text)] * (2 if d == 3 else 1)
    return out


def judged(rows):
    rows = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2], hashlib.sha256(r[3].encode()).hexdigest()))
    seen, out = set(), []
    for _, _, role, text in rows:
        body = text.rstrip(cv.BLANKS)
        fault = "blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else ""
        seen.add((role, text))
        out.append((role, text, fault))
    return rows, out


def slow(rows):
    """Cheapest edits by relaxing every edit from every partial repair, best (cost, letters) per last initial."""
    if not rows:
        return 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest()
    rows, faults = judged(rows)
    best = {"": (0, "", [])}

    def offer(table, key, value):
        if key not in table or value[:2] < table[key][:2]:
            table[key] = value

    def inserted(table):
        table = dict(table)
        for _ in range(4):
            for last, (cost, audit, said) in list(table.items()):
                for role in ("user", "assistant"):
                    if role[0] in NEXT[last]:
                        offer(table, role[0], (cost + 2, audit + "I", [*said, f"{role}:"]))
        return table

    for role, text, fault in faults:
        step = {}
        for last, (cost, audit, said) in inserted(best).items():
            offer(step, last, (cost + 3, audit + "D", said))
            if fault in ("blank", "duplicate"):
                continue
            for letter, new, price in (("K", role, 0), ("R", "user", 2), ("R", "assistant", 2)):
                if new[:1] in NEXT[last]:
                    offer(step, new[0], (cost + price + (fault == "truncated"), audit + letter, [*said, f"{new}:{text}"]))
        best = step
    ended = inserted(best)
    cost, audit, said = min((ended[k] for k in ("", "a") if k in ended), key=lambda v: v[:2])
    turns = [r[1] for r in rows if r[1] is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    kinds = [f[2] for f in faults]
    illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(faults, faults[1:]))
    assert re.fullmatch("(s?(ua)+)?", "".join(x[0] for x in said))
    return (gaps, kinds.count("blank"), kinds.count("duplicate"), kinds.count("truncated"), illegal, cost, audit,
            hashlib.sha256("\n".join(said).encode()).hexdigest())


def of_conv(rows):
    groups = {}
    for r in rows:
        groups.setdefault(r[0], []).append(r)
    return groups


def check(spark, rows, block, partitions=4):
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(partitions)
    got = {r["conv_id"]: tuple(r)[1:] for r in cv.repaired_digests(df, block).collect()}
    left = of_conv(damage(rows))
    want = {conv: slow(left.get(conv, [])) for conv in of_conv(rows)}
    assert got.keys() == want.keys()
    for conv in want:
        assert got[conv] == want[conv], (conv, got[conv], want[conv])


def made(rng, conversations, longest):
    rows = []
    for conv in range(conversations):
        for turn in range(rng.randrange(1, longest)):
            role = rng.choice(["user", "assistant"] * 4 + ["system", "tool", "user", "unknown"])
            if rng.random() < 0.6:
                role = ("user", "assistant")[turn % 2]
            rows.append((conv, turn, role, rng.choice(["", " \t", "Yes.", "No", f"Text {rng.random()}.", f"open {rng.random()}", "What?  \n"])))
    return rows


@pytest.mark.parametrize("block", [1, 3, 4096])
def test_random_conversations(spark, block):
    check(spark, made(random.Random(block), 120, 14), block)


@pytest.mark.parametrize("block", [1, 7, 4096])
def test_one_long_conversation_holds_most_rows(spark, block):
    rng = random.Random(block)
    rows = made(rng, 12, 5)
    roles = ["user"] * 60 + ["assistant"] * 30 + ["system"] * 10 + ["tool"] * 10 + ["user", "assistant"] * 40
    rows += [(99, i, role, f"line {i}" + "." * (i % 3 > 0)) for i, role in enumerate(roles)]
    check(spark, rows, block, 6)


def test_awkward_rows(spark):
    rows = [(None, None, None, None), (None, 3, "user", "a."), (1, None, "user", "first."), (1, None, None, "x"), (1, 0, "assistant", None), (1, 0, "assistant", "b."),
            (1, 0, "assistant", "b."), (1, 9, "user", "b."), (1, 10**12, "", "no role"), (2, 1, "system", "only."), (3, 5, "user", "."), (3, 5, "user", "."),
            (4, 1, "assistant", "é" * 70_000), (4, 2, "user", "\x1c"), (5, -4, "user", "neg!"), (5, -1, "assistant", "x?\n\n")]
    for block in (1, 2, 4096):
        check(spark, rows, block)


def test_conversation_without_rows_left(spark):
    gone = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    check(spark, [(gone, 0, "user", "lost"), (gone + 1000, 1, "user", "stays.")], 4096)


def test_copies_by_the_thousand_and_clashing_columns(spark):
    rows = [(7, 1, "user", "again and again")] * 3000 + [(7, 2, "assistant", "well.")]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "conv_id long, turn long, role string, text string, pos string, edit int")
    told, counts = cv.repair_conversations(df)
    assert told.columns == ["conv_id", "pos", "nth", "edit", "cost", "role", "text"]
    letters = "".join(r["edit"] for r in told.orderBy("conv_id", "pos", "nth").collect())
    assert letters == "K" + "D" * 2999 + "K"
    assert tuple(counts.first()) == (7, 0, 0, 2999, 1, 2999)


def test_empty_table(spark):
    df = spark.createDataFrame([], "conv_id string, turn int, role string, text string")
    assert cv.repaired_digests(df).count() == 0
    told, counts = cv.repair_conversations(df)
    assert told.count() == 0 and counts.count() == 0


def test_every_piece_is_condensed_as_a_full_search_would(spark):
    rng = random.Random(2)
    for _ in range(300):
        codes = bytes(rng.randrange(8) for _ in range(rng.randrange(30)))
        starts, ends = cv.summary(codes)
        for v in range(len(cv.vectors())):
            path = cv.backward(codes, v)
            assert starts[v] == path[0]
            for q in range(4):
                state = q
                for code, after in zip(codes, path[1:]):
                    state = cv._tables()[1][code][after][state][1]
                assert ends[4 * v + q] == state
