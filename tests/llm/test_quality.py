"""Quality ledger against a slow reading of the rules; policies and ablations; awkward input."""

import random
import re

import pytest
from pyspark.sql import functions as F

from cubeloom.llm import quality as q

WORD = re.compile(r"[^\x20\x09-\x0D]+")
AWKWARD = [None, "", " \t\r\n", "a", "a b c d e", "a b c d e a b c d e", "x " * 30, "ab\nab\n\nab \nab", "# $ % word\n# $ % word", "é è ü\x0bñ\x0cö",
           "l1...\nl2…\nl3 …  \nl4", "1234 5678 90 12 34 56 78 90 11 22 33", "\x00 \x1c a", "日本語 のテキスト 😀 😀"]


def slow(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    covered = {k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(i, i + 5)}
    seen, again = set(), 0
    for x in lines:
        again += x in seen
        seen.add(x)
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), again, len(covered))


def ran(spark, texts, **extra):
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    return {r["doc_id"]: r for r in q.ledger(rows).collect()}


def test_measures_against_brute_force(spark):
    rng = random.Random(5)
    texts = list(AWKWARD)
    for n in (4, 5, 6, 9, 40, 200, 700):
        for vocabulary in (1, 2, 4, 40, 5000):
            texts.append("".join(f"w{rng.randrange(vocabulary)}{rng.choice([' ', '  ', chr(9), chr(10), chr(13)])}" for _ in range(n)))
    found = ran(spark, texts)
    for i, text in enumerate(texts):
        r = found[i]
        got = (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"])
        assert got == slow(text), text
        assert bool(r["failed"] & 3) == (got[0] < 10 or 100 * got[4] > 20 * got[0])


@pytest.mark.parametrize("text, windows", [("w " * 50_000, 50_000), (" ".join(map(str, range(60_000))), 0), (" ".join(map(str, range(30_000))) + " # " + " ".join(map(str, range(30_000))), 60_000)])
def test_long_texts(spark, text, windows):
    r = ran(spark, [text])[0]
    assert r["n_repeat_words"] == windows and r["n_words"] == len(text.split())


def test_letters_and_open_lines(spark):
    found = ran(spark, AWKWARD)
    assert found[AWKWARD.index("l1...\nl2…\nl3 …  \nl4")]["n_open_lines"] == 3
    assert found[AWKWARD.index("é è ü\x0bñ\x0cö")]["n_letters"] == 5


def test_repeats_empty_table_and_clashing_columns(spark):
    rows = spark.createDataFrame([(None, "a b", 7, "x"), (None, "a b", 7, "x"), (1, None, None, None)], "doc_id long, text string, FAILED int, n_words string")
    out = q.ledger(rows)
    assert out.columns == ["doc_id", "text", *q.MEASURES, "failed"]
    assert sorted(r["n_words"] for r in out.collect()) == [0, 2, 2]
    assert q.ledger(rows.where("false")).count() == 0
    assert [tuple(r)[2:] for r in q.ablation(q.ledger(rows.where("false"))).collect()] == [(0, 0, 0)] * len(q.POLICIES[q.CURRENT].rules)


@pytest.mark.parametrize("version", list(q.POLICIES))
def test_policies_and_ablation_agree_with_the_rules_one_by_one(spark, version):
    texts = [t for t in AWKWARD] + ["word " * 12, "good words " * 3 + "# " * 9 + "and so on we go again", " ".join(f"w{i}" for i in range(30))]
    led = q.ledger(spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")).cache()
    rules = [r for r in q.RULES if r.name in q.POLICIES[version].rules]
    flags = [tuple(r) for r in led.select(*[r.fails() for r in rules], q.passes(F.col("failed"), version), "n_words").collect()]
    assert all(f[-2] == (not any(f[:-2])) for f in flags)
    got = {r["rule"]: (r["failed_docs"], r["only_docs"], r["only_words"]) for r in q.ablation(led, version).collect()}
    for i, rule in enumerate(rules):
        alone = [f for f in flags if f[i] and sum(f[:-2]) == 1]
        assert got[rule.name] == (sum(f[i] for f in flags), len(alone), sum(f[-1] for f in alone))


def test_no_python_and_no_shuffle_in_the_ledger(spark):
    plan = q.ledger(spark.createDataFrame([(1, "a")], "doc_id long, text string"))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan and "Arrow" not in plan
