"""Mixing sources to target weights: budgets flow down a domain-language-source tree.

Everything here is a join, an aggregate or a window over small tables of tree nodes; no row
leaves the JVM, and texts are never shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored, table, without

LEVELS = ("domain", "language", "source_name")
# production weights of tree nodes; a path that is not listed weighs 1
WEIGHTS: dict[tuple[str, ...], int] = {
    ("curated",): 3, ("community",): 2, ("crawl",): 1,
    **{(d, lang): w for d in ("curated", "community", "crawl") for lang, w in (("en", 5), ("de", 2), ("fr", 2), ("es", 1))},
}
SEED = "mix-1"


def default_domain(source: Column) -> Column:
    """The domain of a source: the catch-all source is the crawl, one-digit sources are the community."""
    return F.when(source == "src0", "crawl").when(F.length(source) == 4, "community").otherwise("curated")


def count_words(text: Column) -> Column:
    """Tokens of a text: what ASCII white space separates."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def _share(nodes: DataFrame, parent: list[str]) -> DataFrame:
    """Deal ``budget`` of each parent to its children (``weight``, ``cap``) as ``share``.

    A child gets budget by weight, up to its capacity; what it can't use goes to its
    siblings by weight. Children are taken by capacity per weight: as long as one is full
    at the going rate, it gets its capacity and the rest is dealt on. Shares are whole
    tokens, rounded down.
    """
    order = Window.partitionBy(*parent).orderBy(F.col("cap") / F.col("weight"), "name")
    before, after = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(0, Window.unboundedFollowing)
    nodes = nodes.withColumn("used", F.coalesce(F.sum("cap").over(before), F.lit(0))).withColumn("rest", F.sum("weight").over(after))
    left = (F.col("budget") - F.col("used")).cast("double")
    nodes = nodes.withColumn("full", F.col("cap").cast("double") * F.col("rest") <= left * F.col("weight"))
    whole = Window.partitionBy(*parent)
    nodes = nodes.withColumn("spent", F.coalesce(F.sum(F.when(F.col("full"), F.col("cap"))).over(whole), F.lit(0)))
    nodes = nodes.withColumn("open", F.sum(F.when(~F.col("full"), F.col("weight"))).over(whole))
    rate = (F.col("budget") - F.col("spent")).cast("double") * F.col("weight") / F.col("open")
    return nodes.withColumn("share", F.when(F.col("full"), F.col("cap")).otherwise(
        F.least(F.col("cap"), F.floor(rate).cast("long"))))


def leaf_budgets(leaves: DataFrame, weights: dict[tuple[str, ...], int], fraction: float, max_epochs: int) -> DataFrame:
    """``leaves`` (``domain, language, source_name, tokens``) with their ``share`` of the budget.

    The budget is ``fraction`` of all tokens. Capacities are tokens times ``max_epochs``,
    summed up the tree, and budgets are dealt from the root down: a shortage is thus made
    up by siblings first, and reaches the parent's siblings only when the whole parent is
    used up.
    """
    spark = leaves.sparkSession
    listed = [[*path, *[None] * (3 - len(path)), int(w)] for path, w in weights.items()]
    known = spark.createDataFrame(listed or [[None, None, None, 1]], "d string, l string, s string, w long")
    caps = leaves.withColumn("cap", F.col("tokens") * max_epochs)
    out = caps.agg(F.floor(F.sum("tokens").cast("double") * fraction).cast("long").alias("budget"))
    for depth in range(3):
        parent, own = list(LEVELS[:depth]), list(LEVELS[: depth + 1])
        level = caps.groupBy(*own).agg(F.sum("cap").alias("cap"))
        on = [F.col(c) == F.col(k) for c, k in zip(own, ("d", "l", "s"))]
        wanted = known.where(" and ".join(["true", *[f"{k} is null" for k in ("d", "l", "s")[depth + 1 :]], f"{('d', 'l', 's')[depth]} is not null"]))
        level = level.join(wanted, on, "left").select(*own, "cap", F.coalesce("w", F.lit(1)).alias("weight"), F.col(own[-1]).alias("name"))
        level = level.where("weight > 0")
        level = level.join(out, parent) if parent else level.withColumn("budget", out.select("budget").scalar())
        out = _share(level, parent).select(*own, F.col("share").alias("budget"))
    return leaves.join(out.withColumnRenamed("budget", "share"), list(LEVELS))


def order_key(seed: str, epoch: Column, doc_id: Column) -> Column:
    """The place of a document in the shuffled order of an epoch."""
    return F.md5(F.concat_ws(":", F.lit(seed), epoch.cast("string"), F.coalesce(doc_id.cast("string"), F.lit("-"))).cast("binary"))


def slot_digits(n: Column) -> Column:
    """Hexadecimal digits of the order key that make a slot in a leaf of ``n`` documents: 16 ** digits >= sqrt(n)."""
    return F.greatest(F.lit(1), F.ceil(F.log2(n.cast("double")) / 8)).cast("int")


def mix(docs: DataFrame, weights: dict[tuple[str, ...], int] | None = None, fraction: float = 0.8, max_epochs: int = 2,
        seed: str = SEED, domain: Column | None = None, tokens: Column | None = None) -> DataFrame:
    """Rows of ``docs`` drawn to the weights, with ``domain``, ``n_tokens`` and ``epoch`` added.

    A leaf is a source within a language within a domain; nulls are leaves named "none". A
    leaf with a share of k times its tokens and a bit gets all its documents in epochs 0 to
    k - 1, and of epoch k the longest run in that epoch's seeded order whose tokens fit the
    rest. No leaf gets more than its share, the shares sum to the budget but for rounding
    (or to all capacity), and a document comes at most ``max_epochs`` times. Documents
    without tokens cost nothing, so they come as often as the order reaches them. Rows that
    repeat an id stand or fall together. Weight 0 leaves a node out. An empty table gives
    an empty result; columns of the input named like an added one are replaced.

    Running totals of a leaf of any size: tokens are summed by leaf and leading digits of
    the order key first, which finds the slot in which the leaf's run ends; only documents
    of that slot, ids and counts alone, are put in order. A leaf of n documents has about
    the square root of n slots (up to 16 times as many), so both windows stay small. What comes back is one key per
    leaf, and rows are kept by comparing keys.
    """
    source = F.coalesce(F.col("source").cast("string"), F.lit("none"))
    count = count_words(F.col("text")) if tokens is None else tokens
    rows = docs.withColumns({
        "__t": count.cast("long"), "__d": default_domain(source) if domain is None else domain,
        "__l": F.coalesce(F.col("lang").cast("string"), F.lit("none")), "__s": source})
    names = [F.col("__d").alias("domain"), F.col("__l").alias("language"), F.col("__s").alias("source_name")]
    light = stored(rows.select(*names, F.col("doc_id").alias("id"), F.col("__t").alias("t")), "mix-tokens")
    leaves = light.groupBy(*LEVELS).agg(F.sum("t").alias("tokens"), F.count(F.lit(1)).alias("n"))
    shares = leaf_budgets(leaves, WEIGHTS if weights is None else weights, fraction, max_epochs)
    whole = F.when(F.col("tokens") > 0, F.floor(F.col("share") / F.col("tokens"))).otherwise(F.lit(0)).cast("long")
    shares = stored(shares.withColumn("whole", whole).withColumn("rest", F.col("share") - F.col("whole") * F.col("tokens")).withColumn(
        "digits", slot_digits(F.col("n"))), "mix-shares")

    placed = light.join(shares.select(*LEVELS, "whole", "rest", "digits"), list(LEVELS))
    placed = placed.withColumn("key", order_key(seed, F.col("whole"), F.col("id"))).withColumn("slot", F.substring("key", F.lit(1), F.col("digits")))
    slots = placed.groupBy(*LEVELS, "slot", "rest").agg(F.sum("t").alias("t"))
    slots = slots.withColumn("end", F.sum("t").over(Window.partitionBy(*LEVELS).orderBy("slot")))
    last = stored(slots.where("end > rest").groupBy(*LEVELS).agg(
        F.min(F.struct("slot", (F.col("rest") - F.col("end") + F.col("t")).alias("room"))).alias("m")
    ).select(*LEVELS, F.col("m.slot").alias("slot"), F.col("m.room").alias("room")), "mix-slots")
    inside = placed.join(last, [*LEVELS, "slot"]).withColumn(
        "run", F.sum("t").over(Window.partitionBy(*LEVELS).orderBy("key")))
    ends = inside.where("run <= room").groupBy(*LEVELS).agg(F.max("key").alias("end"))
    # leaves without a last slot take all of their last epoch; those without an end stop before the slot
    plan = shares.join(last, list(LEVELS), "left").join(ends, list(LEVELS), "left").select(
        *[F.col(c).alias(f"__p{i}") for i, c in enumerate(LEVELS)], F.col("whole").alias("__w"),
        F.when(F.col("slot").isNull(), F.lit("g")).otherwise(F.coalesce("end", "slot")).alias("__end"))
    plan = stored(plan, "mix-plan")

    drawn = rows.join(plan, (F.col("__d") == F.col("__p0")) & (F.col("__l") == F.col("__p1")) & (F.col("__s") == F.col("__p2")))
    partial = order_key(seed, F.col("__w"), F.col("doc_id")) <= F.col("__end")
    epochs = F.when(partial, F.sequence(F.lit(0).cast("long"), F.col("__w"))).when(
        F.col("__w") > 0, F.sequence(F.lit(0).cast("long"), F.col("__w") - 1)).otherwise(F.array().cast("array<long>"))
    drawn = drawn.withColumn("__e", F.explode(epochs)).where(F.col("__e") < max_epochs)
    kept = without(docs, "domain", "n_tokens", "epoch").columns
    return drawn.select(*[F.col(f"`{c}`") for c in kept], F.col("__d").alias("domain"), F.col("__t").alias("n_tokens"),
                        F.col("__e").cast("int").alias("epoch"))


def op4_mixing_sources(spark, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents")).select("doc_id", "domain", "lang", "source", "n_tokens", "epoch")


def _level_sql(name: str, parent: list[str], own: list[str], budget: str) -> str:
    """One level of the tree: the same water-filling with SQL windows."""
    by = f"PARTITION BY {', '.join(parent)}" if parent else ""
    link = f"JOIN {budget} b USING ({', '.join(parent)})" if parent else f"CROSS JOIN {budget} b"
    paths = [(p, w) for p, w in WEIGHTS.items() if len(p) == len(own)]
    cases = " ".join("WHEN " + " AND ".join(f"{c} = '{v}'" for c, v in zip(own, p)) + f" THEN {w}" for p, w in paths)
    weight = f"CASE {cases} ELSE 1 END" if cases else "1"
    keys = ", ".join(own)
    return f"""{name}_a AS (
  SELECT {keys}, CAST(sum(tokens) * 2 AS BIGINT) AS cap, {weight} AS weight FROM leaves GROUP BY {keys}
), {name}_b AS (
  SELECT a.*, b.budget, coalesce(sum(cap) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS used,
         sum(weight) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rest
  FROM {name}_a a {link} WINDOW o AS ({by} ORDER BY CAST(cap AS DOUBLE) / weight, {own[-1]})
), {name}_c AS (
  SELECT *, CAST(cap AS DOUBLE) * rest <= CAST(budget - used AS DOUBLE) * weight AS is_full FROM {name}_b
), {name}_d AS (
  SELECT *, coalesce(sum(cap) FILTER (is_full) OVER w, 0) AS spent, sum(weight) FILTER (NOT is_full) OVER w AS free
  FROM {name}_c WINDOW w AS ({by})
), {name} AS (
  SELECT {keys}, CASE WHEN is_full THEN cap
                 ELSE least(cap, CAST(floor(CAST(budget - spent AS DOUBLE) * weight / free) AS BIGINT)) END AS budget
  FROM {name}_d
)"""


OP4_SQL = r"""
WITH words AS (
  SELECT doc_id, lang, source, coalesce(lang, 'none') AS language, coalesce(source, 'none') AS source_name,
         CASE WHEN coalesce(source, 'none') = 'src0' THEN 'crawl' WHEN length(coalesce(source, 'none')) = 4 THEN 'community'
              ELSE 'curated' END AS domain,
         CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS t
  FROM documents
), leaves AS (
  SELECT domain, language, source_name, CAST(sum(t) AS BIGINT) AS tokens FROM words GROUP BY ALL
), root AS (
  SELECT CAST(floor(CAST(sum(tokens) AS DOUBLE) * 0.8) AS BIGINT) AS budget FROM leaves
), """ + ", ".join([
    _level_sql("l1", [], ["domain"], "root"),
    _level_sql("l2", ["domain"], ["domain", "language"], "l1"),
    _level_sql("l3", ["domain", "language"], ["domain", "language", "source_name"], "l2"),
]) + f""", shares AS (
  SELECT leaves.*, l3.budget AS share, CASE WHEN tokens > 0 THEN l3.budget // tokens ELSE 0 END AS whole
  FROM leaves JOIN l3 USING (domain, language, source_name)
), ordered AS (
  SELECT w.*, s.whole, s.share - s.whole * s.tokens AS rest,
         md5('{SEED}:' || s.whole || ':' || coalesce(CAST(w.doc_id AS VARCHAR), '-')) AS k
  FROM words w JOIN shares s USING (domain, language, source_name)
), runs AS (
  SELECT *, sum(t) OVER (PARTITION BY domain, language, source_name ORDER BY k) AS run FROM ordered
), drawn AS (
  SELECT *, unnest(range(CAST(CASE WHEN run <= rest THEN whole + 1 ELSE whole END AS BIGINT))) AS e FROM runs
)
SELECT doc_id, domain, lang, source, t AS n_tokens, CAST(e AS INTEGER) AS epoch FROM drawn WHERE e < 2
"""
