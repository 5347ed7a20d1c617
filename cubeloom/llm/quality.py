"""Quality rules: a ledger of failure bits and measurements, and versioned policies over it."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import table, without

BLANKS = "\t\n\x0b\x0c\r "
SYMBOLS = "#*$%&|<>"
WINDOW = 5  # words of a window that may repeat
MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_letters", "n_open_lines")


@dataclass(frozen=True)
class Rule:
    """One bit of the ledger; ``fails`` is a condition on the measurements."""

    bit: int
    name: str
    fails: Callable[[], Column]


def _c(name: str) -> Column:
    return F.col(name)


# A bit never changes its meaning: a rule that is altered gets a new one, so old ledgers stay valid.
RULES = (
    Rule(0, "few_words", lambda: _c("n_words") < 10),
    Rule(1, "repeated_windows", lambda: 100 * _c("n_repeat_words") > 20 * _c("n_words")),
    Rule(2, "many_symbols", lambda: 10 * _c("n_symbols") > _c("n_words")),
    Rule(3, "duplicate_lines", lambda: 100 * _c("n_dup_lines") > 50 * _c("n_lines")),
    Rule(4, "short_words", lambda: _c("word_chars") < 2 * _c("n_words")),
    Rule(5, "long_words", lambda: _c("word_chars") > 15 * _c("n_words")),
    Rule(6, "few_letters", lambda: 100 * _c("n_letters") < 40 * _c("word_chars")),
    Rule(7, "unfinished_lines", lambda: 100 * _c("n_open_lines") > 30 * _c("n_lines")),
)


@dataclass(frozen=True)
class Policy:
    """A document is kept if none of the policy's rules failed. Published versions are never changed."""

    version: str
    rules: tuple[str, ...]

    @property
    def mask(self) -> int:
        bits = {r.name: r.bit for r in RULES}
        return sum(1 << bits[name] for name in self.rules)


BASE = Policy("base", ("few_words", "repeated_windows"))
POLICIES = {p.version: p for p in (
    BASE,
    Policy("1", (*BASE.rules, "many_symbols", "duplicate_lines")),
    Policy("2", (*BASE.rules, "many_symbols", "duplicate_lines", "short_words", "long_words", "few_letters", "unfinished_lines")),
)}
CURRENT = "2"


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` over a value that is computed once per row, however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _repeated_words(words: Column) -> Column:
    """Words that stand in a window found twice or more in the text, the first one included.

    Equal windows have equal hashes, so a text whose window hashes all differ has none: that
    test is a set of longs. Otherwise windows are sorted by hash and then by their words, which
    puts equal ones next to each other; the starts of those that have an equal neighbour are put
    in order again, and each adds the words that the one before does not cover.
    """
    def starts(w: Column) -> Column:
        return F.sequence(F.lit(0), F.size(w) - WINDOW)

    def hash_at(w: Column, i: Column) -> Column:
        return F.xxhash64(*[F.get(w, i + k) for k in range(WINDOW)])

    def covered(w: Column, hashes: Column) -> Column:
        windows = F.sort_array(F.transform(hashes, lambda h, i: F.struct(
            h.alias("h"), F.concat_ws(" ", F.slice(w, i + 1, WINDOW)).alias("w"), i.alias("i"))))

        def same(a: Column, b: Column) -> Column:
            return F.coalesce((a["h"] == b["h"]) & (a["w"] == b["w"]), F.lit(False))

        repeated = _let(windows, lambda s: F.transform(F.filter(
            F.transform(s, lambda x, i: F.struct(x["i"].alias("i"), (same(x, F.get(s, i - 1)) | same(x, F.get(s, i + 1))).alias("again"))),
            lambda x: x["again"]), lambda x: x["i"]))
        # the word behind the last covered one is carried together with the count
        state = F.struct(F.lit(0).alias("behind"), F.lit(0).cast("long").alias("n"))
        return F.aggregate(F.sort_array(repeated), state, lambda s, i: F.struct(
            (i + WINDOW).alias("behind"), (s["n"] + i + WINDOW - F.greatest(i, s["behind"])).alias("n")), lambda s: s["n"])

    def counted(w: Column) -> Column:
        found = _let(F.transform(starts(w), lambda i: hash_at(w, i)), lambda hashes: F.when(
            F.size(F.array_distinct(hashes)) < F.size(hashes), covered(w, hashes)).otherwise(F.lit(0).cast("long")))
        return F.when(F.size(w) >= WINDOW, found).otherwise(F.lit(0).cast("long"))

    return counted(words)


def measures(text: Column) -> Column:
    """All measurements of a text as one struct; words are what ASCII white space separates, lines what line feeds do.

    ``n_lines`` counts lines with a word, ``n_dup_lines`` those equal to an earlier one,
    ``n_open_lines`` those that end in an ellipsis. A null counts as an empty text.
    """
    def length(c: Column) -> Column:
        return F.char_length(c).cast("long")

    def gone(c: Column, signs: str) -> Column:
        return F.translate(c, signs, "")

    def of_text(t: Column) -> Column:
        blanks = F.lit(r"[\x20\x09-\x0D]+")
        words = F.filter(F.split(t, r"[\x20\x09-\x0D]+"), lambda w: w != "")
        lines = F.filter(F.split(t, "\n"), lambda x: gone(x, BLANKS) != "")
        from_words = _let(words, lambda w: F.struct(F.size(w).cast("long").alias("n"), _repeated_words(w).alias("repeated")))
        from_lines = _let(lines, lambda x: F.struct(
            F.size(x).cast("long").alias("n"), (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("twice"),
            F.size(F.filter(x, lambda y: F.rtrim(y).endswith("...") | F.rtrim(y).endswith("…"))).cast("long").alias("open")))
        return _let(F.struct(from_words.alias("w"), from_lines.alias("l")), lambda m: F.struct(
            m["w"]["n"].alias("n_words"), length(gone(t, BLANKS)).alias("word_chars"), (length(t) - length(gone(t, SYMBOLS))).alias("n_symbols"),
            m["l"]["n"].alias("n_lines"), m["l"]["twice"].alias("n_dup_lines"), m["w"]["repeated"].alias("n_repeat_words"),
            length(F.regexp_replace(t, r"[^\p{L}]+", "")).alias("n_letters"), m["l"]["open"].alias("n_open_lines")))

    return _let(F.coalesce(text, F.lit("")), of_text)


def ledger(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Add the measurements and ``failed``, the bits of all rules that fail, to every row.

    Every rule is evaluated once, on whole texts; policies only look at the bits. A null text
    counts as empty (it fails ``few_words``). Rows are independent, so repeated rows get
    the same answer and nothing is shuffled. Columns of the input named like an added one are replaced.
    """
    rows = without(docs, *MEASURES, "failed")
    measured = docs.select(*[F.col(f"`{c}`") for c in rows.columns], measures(F.col(f"`{text_col}`").cast("string")).alias("__m"))
    measured = measured.select(*[F.col(f"`{c}`") for c in rows.columns], *[F.col("__m")[m].alias(m) for m in MEASURES])
    bits = F.lit(0).cast("long")
    for rule in RULES:
        bits = bits.bitwiseOR(F.when(rule.fails(), F.lit(1 << rule.bit).cast("long")).otherwise(F.lit(0).cast("long")))
    return measured.withColumn("failed", bits)


def passes(failed: Column, version: str = CURRENT) -> Column:
    """The verdict of a policy on failure bits."""
    return failed.bitwiseAND(F.lit(POLICIES[version].mask).cast("long")) == 0


def ablation(ledgered: DataFrame, version: str = CURRENT) -> DataFrame:
    """What each rule of a policy does: ``rule, bit, failed_docs, only_docs, only_words``.

    ``only_docs`` is the number of documents that would be kept if that rule alone were left
    out: those whose bits under the policy's mask are the rule's bit. The ledger is first
    folded to one row per pattern of bits (at most two to the number of rules), before the
    shuffle; the policy is applied to the patterns. An empty ledger gives zeros.
    """
    policy = POLICIES[version]
    mask = F.lit(policy.mask).cast("long")
    folded = ledgered.groupBy(F.col("failed").bitwiseAND(mask).alias("bits")).agg(F.count(F.lit(1)).alias("docs"), F.sum("n_words").alias("words"))
    wanted = [r for r in RULES if r.name in policy.rules]
    sums = []
    for rule in wanted:
        bit = F.lit(1 << rule.bit).cast("long")
        hit, alone = F.col("bits").bitwiseAND(bit) != 0, F.col("bits") == bit
        sums.append(F.struct(F.lit(rule.name).alias("rule"), F.lit(rule.bit).alias("bit"), *[
            F.coalesce(F.sum(F.when(cond, F.col(value))), F.lit(0)).cast("long").alias(name)
            for name, cond, value in (("failed_docs", hit, "docs"), ("only_docs", alone, "docs"), ("only_words", alone, "words"))]))
    return folded.agg(F.array(*sums).alias("rules")).select(F.inline("rules"))


def op11_quality_rules(spark, sf_dir: str) -> DataFrame:
    found = ledger(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                        (~passes(F.col("failed"), "base")).alias("base_failed"), passes(F.col("failed")).alias("kept"), "failed")


OP11_SQL = r"""
WITH texts AS (SELECT doc_id, coalesce(text, '') AS text FROM documents), split AS (
  SELECT doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words,
         list_filter(string_split(text, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines
  FROM texts
), windows AS (
  SELECT doc_id, unnest(range(1, len(words) - 3)) AS i, words FROM split WHERE len(words) >= 5
), repeated AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, words[i:i + 4]) AS times FROM windows) WHERE times > 1
), covered AS (
  SELECT doc_id, count(DISTINCT place) AS n FROM (SELECT doc_id, unnest(range(i, i + 5)) AS place FROM repeated) GROUP BY doc_id
), measured AS (
  SELECT s.doc_id, len(words)::BIGINT AS n_words, length(array_to_string(words, ''))::BIGINT AS word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols, len(lines)::BIGINT AS n_lines,
         (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(c.n, 0)::BIGINT AS n_repeat_words,
         length(regexp_replace(text, '[^\p{L}]', '', 'g'))::BIGINT AS n_letters,
         len(list_filter(lines, lambda l: regexp_matches(l, '(\.\.\.|…) *$')))::BIGINT AS n_open_lines
  FROM split s LEFT JOIN covered c ON s.doc_id = c.doc_id
), ruled AS (
  SELECT *, (n_words < 10)::BIGINT + 2 * (100 * n_repeat_words > 20 * n_words)::BIGINT + 4 * (10 * n_symbols > n_words)::BIGINT
         + 8 * (100 * n_dup_lines > 50 * n_lines)::BIGINT + 16 * (word_chars < 2 * n_words)::BIGINT + 32 * (word_chars > 15 * n_words)::BIGINT
         + 64 * (100 * n_letters < 40 * word_chars)::BIGINT + 128 * (100 * n_open_lines > 30 * n_lines)::BIGINT AS failed
  FROM measured
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, failed & 3 <> 0 AS base_failed, failed = 0 AS kept, failed FROM ruled
"""
