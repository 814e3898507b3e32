"""Mixing sources to target weights: hierarchical token budgets over a domain-language-source tree.

A token budget enters at the root and is shared among siblings by weight. A node whose documents cannot fill its share
(over at most ``epochs`` passes) is filled, and what it leaves goes to its siblings by their weights; because a node's own
share is bounded by all that lies below it, a shortage reaches the node's siblings only when no sibling further down can
take it. Each leaf then takes whole passes and, of one more pass in seeded order, the longest prefix within its budget.

The tree has one row per leaf; sharing is windows over siblings. The prefix is found without ordering a leaf: tokens are
summed in ``BINS`` ranges of the seeded hash, and only the range that holds the cut is ordered. So a leaf that holds a third
of all rows is never in one task.

Defined cases: null text has no tokens; null domain, language or source is the branch ``(none)``; a weight that is
missing counts as 1, and 0 takes nothing; rows with the same seeded hash (repeated rows) stand or fall together; an
empty table gives an empty result; other columns are not read, and their names cannot clash with the tree's.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import is_small, materialize

SEED, EPOCHS, SHARE = 10, 2, 0.6
NONE = "(none)"
#: Hex digits of the seeded hash that name a range: 16 ** 3 ranges.
DIGITS = 3
TREE = ["domain", "language", "origin"]


def token_count(text: Column) -> Column:
    """Words between ASCII blanks."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("bigint")


def seeded(doc_id: Column, epoch: Column, seed: int = SEED) -> Column:
    """Place of a document in the order of one pass."""
    return F.md5(F.concat(F.lit(f"{seed}:"), epoch.cast("string"), F.lit(":"), F.coalesce(doc_id.cast("string"), F.lit(""))))


def share_out(children: DataFrame, parents: list[str], key: str) -> DataFrame:
    """Adds ``budget`` to children (weight, capacity, pool) by filling them to equal height per weight.

    Sorted by capacity per weight, the filled children are a prefix; the first that is not filled fixes the height.
    """
    group = Window.partitionBy(*parents) if parents else Window.partitionBy(F.lit(0))
    order = group.orderBy(F.col("capacity") / F.col("weight"), key)
    spent = F.coalesce(F.sum("capacity").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    weight_left = F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing))
    ranked = children.filter("weight > 0").withColumn("height", (F.col("pool") - spent) / weight_left)
    filled = F.col("capacity") <= F.col("height") * F.col("weight")
    marked = ranked.withColumn("filled", filled)
    height = F.first(F.when(~F.col("filled"), F.col("height")), ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    return marked.withColumn("budget", F.when(F.col("filled"), F.col("capacity")).otherwise(F.floor(height * F.col("weight")))).drop("height", "filled", "pool")


def budgets(leaves: DataFrame, weights: DataFrame, epochs: int, share: float) -> DataFrame:
    """Leaf budgets: domain, language, origin, tokens, budget. ``weights``: the tree's columns (null below a node) and weight."""
    capacity = leaves.withColumn("capacity", F.col("tokens") * epochs)
    level = capacity.groupBy("domain").agg(F.sum("capacity").alias("capacity"))
    pool = capacity.agg(F.floor(F.coalesce(F.sum("tokens"), F.lit(0)) * F.lit(share)).alias("pool"))
    above = level.crossJoin(F.broadcast(pool))  # one row on the right
    for depth, column in enumerate(TREE):
        path = TREE[: depth + 1]
        named = weights.filter(F.col(column).isNotNull())
        for below in TREE[depth + 1 :]:
            named = named.filter(F.col(below).isNull())
        weighed = above.join(named.select(*path, "weight"), path, "left").withColumn("weight", F.coalesce("weight", F.lit(1)).cast("bigint"))
        shared = share_out(weighed, path[:-1], column)
        if column == TREE[-1]:
            return shared.join(leaves, TREE).select(*TREE, "tokens", "budget")
        below = TREE[: depth + 2]
        level = capacity.groupBy(*below).agg(F.sum("capacity").alias("capacity"))
        above = level.join(shared.select(*path, F.col("budget").alias("pool")), path)
    raise AssertionError


def plan(docs: DataFrame, weights: DataFrame, domain: Column, doc_id: str, text: str, lang: str, source: str, epochs: int, share: float, seed: int) -> DataFrame:
    """One row per leaf: its path, the whole passes, and the last seeded hash taken in the next pass."""
    rows = materialize(docs.select(*_row(domain, doc_id, text, lang, source)), "mix-rows")
    leaves = materialize(rows.groupBy(*TREE).agg(F.sum("n_tokens").alias("tokens")).filter("tokens > 0"), "mix-leaves")
    found = budgets(leaves, weights, epochs, share).withColumn("passes", F.floor(F.col("budget") / F.col("tokens")))
    found = materialize(found.withColumn("rest", F.col("budget") - F.col("passes") * F.col("tokens")), "mix-budgets")
    placed = _attach(rows.filter("n_tokens > 0"), found).withColumn("place", seeded(F.col("doc_id"), F.col("passes"), seed)).withColumn("bin", F.substring("place", 1, DIGITS))
    bins = placed.groupBy(*TREE, "bin", "passes", "rest").agg(F.sum("n_tokens").alias("n"))
    upto = F.sum("n").over(Window.partitionBy(*TREE).orderBy("bin"))
    # The range of the cut is the first whose sum passes the rest of the budget; a leaf has at most 16 ** DIGITS ranges.
    cut = bins.withColumn("upto", upto).filter(F.col("upto") > F.col("rest"))
    cut = cut.groupBy(*TREE).agg(F.min_by(F.struct("bin", (F.col("upto") - F.col("n")).alias("before")), "bin").alias("cut"))
    cut = materialize(cut.select(*TREE, F.col("cut.bin").alias("cut_bin"), F.col("cut.before").alias("before")), "mix-cuts")
    inside = _attach(placed, cut).filter("bin = cut_bin")
    running = F.sum("n_tokens").over(Window.partitionBy(*TREE).orderBy("place").rangeBetween(Window.unboundedPreceding, 0))
    taken = inside.withColumn("upto", F.col("before") + running).filter(F.col("upto") <= F.col("rest")).groupBy(*TREE).agg(F.max("place").alias("last"))
    ends = cut.join(taken, TREE, "left").select(*TREE, F.coalesce("last", "cut_bin").alias("last"))
    return materialize(found.join(ends, TREE, "left").select(*TREE, "passes", "last"), "mix-plan")


def _row(domain: Column, doc_id: str, text: str, lang: str, source: str) -> list[Column]:
    branch = [F.coalesce(x.cast("string"), F.lit(NONE)).alias(name) for x, name in zip((domain, F.col(lang), F.col(source)), TREE, strict=True)]
    return [F.col(doc_id).alias("doc_id"), token_count(F.col(text)).alias("n_tokens"), *branch]


def _attach(rows: DataFrame, leaves: DataFrame) -> DataFrame:
    """Join rows to their leaf. A leaf table proven small is broadcast; a larger one meets the rows in a shuffle that splits skew."""
    return rows.join(F.broadcast(leaves) if is_small(leaves) else leaves, TREE)


def mix(docs: DataFrame, weights: DataFrame, domain: Column, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", source: str = "source", epochs: int = EPOCHS, share: float = SHARE, seed: int = SEED) -> DataFrame:
    """One row per selected copy: doc_id, domain, language, origin, epoch, n_tokens."""
    leaves = plan(docs, weights, domain, doc_id, text, lang, source, epochs, share, seed)
    rows = _attach(docs.select(*_row(domain, doc_id, text, lang, source)).filter("n_tokens > 0"), leaves)
    return rows.select("doc_id", *TREE, F.explode(_copies(seed, F.col("doc_id"))).alias("epoch"), "n_tokens")


def _copies(seed: int, doc_id: Column) -> Column:
    """The passes in which a row is taken."""
    extra = seeded(doc_id, F.col("passes"), seed) <= F.col("last")
    many = F.col("passes") + F.coalesce(extra, F.lit(False)).cast("bigint")
    return F.when(many > 0, F.sequence(F.lit(0).cast("bigint"), many - 1))


def mixed_documents(docs: DataFrame, weights: DataFrame, domain: Column, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", source: str = "source", epochs: int = 1, share: float = SHARE, seed: int = SEED) -> DataFrame:
    """The selected documents with all their columns, a row for each pass that takes it."""
    leaves = plan(docs, weights, domain, doc_id, text, lang, source, epochs, share, seed)
    leaves = leaves.select(*(F.col(x).alias(f"_mix_{x}") for x in TREE), "passes", "last")
    own = [x.alias(f"_mix_{name}") for x, name in zip(_row(domain, doc_id, text, lang, source)[1:], ["n", *TREE], strict=True)]
    marked = docs.select(F.struct("*").alias("_mix_row"), F.col(doc_id).alias("_mix_id"), *own).filter("_mix_n > 0")
    joined = marked.join(F.broadcast(leaves) if is_small(leaves) else leaves, [f"_mix_{x}" for x in TREE])
    return joined.withColumn("_mix_epoch", F.explode(_copies(seed, F.col("_mix_id")))).select("_mix_row.*")
