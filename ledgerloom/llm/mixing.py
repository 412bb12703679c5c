"""Mixing sources to target weights by hierarchical budgets, in DataFrame operations only.

A token budget is handed down a tree, domain -> language -> source. At each node it
is split among the children by their weights; a child cannot take more than its
whole subtree holds in ``epochs`` passes, and what it cannot take goes to its
siblings by their weights. Only what all siblings together cannot take is missing
one level up, so shortages are made good among siblings before ancestors.

Children with the smallest capacity for their weight fill first; with the children
in that order, child ``i`` is full exactly when the budget left by those before it,
shared by weight among it and those behind it, reaches its capacity. That is one
window over the children and is done in integers (exact, alike on every engine).
Fractions of a token that division leaves are not handed out.

A leaf's tokens are passes (epochs) over its documents, each in an order of its own
drawn from the seed. The budget buys whole epochs and a prefix of one more: the
documents in that epoch's order whose running total stays within the rest. Running
totals are taken in two steps, over slices of the order and inside each slice, so a
leaf with a third of all rows is spread over as many tasks as it has slices.

Null domain, language or source are nodes named ``unknown``. Texts without tokens take
no budget and come with every whole epoch of their leaf (and never for its prefix
alone). Repeated rows are documents of their own; ties in the order, only possible
between equal ids, are broken by the token count, and equal rows take the same
place. Weights of absent nodes are ignored, nodes without weights weigh 1, weights
below 0 count as 0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.shared import saved

LEVELS = ("domain", "lang", "source")
EPOCHS = 3
SEED = 17
#: Hexadecimal digits of the order's key that name a slice.
SLICE_DIGITS = 3
#: Parts of a leaf while its documents meet their budget.
SALTS = 64
BIG = "decimal(38,0)"


def token_count(text: Column) -> Column:
    """Words between white space (space, \\t, \\n, \\v, \\f, \\r)."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def split_budget(nodes: DataFrame, parent: list[str], node: str) -> DataFrame:
    """``nodes(*parent, node, weight, capacity, budget)`` -> with ``share`` of the budget.

    ``weight``, ``capacity``, ``budget`` are integers; ``budget`` is the parent's."""
    big = nodes.withColumns({c: F.col(c).cast(BIG) for c in ("weight", "capacity", "budget")})
    live = F.col("weight") > 0
    # order by capacity / weight: compared without fractions by a wide quotient
    key = F.when(live, F.floor(F.col("capacity") * F.lit(10**9).cast(BIG) / F.col("weight")).cast(BIG))
    order = Window.partitionBy(*parent).orderBy(F.col("key").asc_nulls_last(), node)
    whole = Window.partitionBy(*parent)
    ranked = big.withColumn("key", key).withColumns({
        "before": F.coalesce(F.sum(F.when(live, F.col("capacity"))).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
        "rest": F.sum(F.when(live, F.col("weight")).otherwise(0)).over(order.rowsBetween(0, Window.unboundedFollowing)),
    })
    full = live & (F.col("capacity") * F.col("rest") <= (F.col("budget") - F.col("before")) * F.col("weight"))
    filled = ranked.withColumn("full", full).withColumns({
        "taken": F.sum(F.when(F.col("full"), F.col("capacity")).otherwise(0)).over(whole),
        "open": F.sum(F.when(live & ~F.col("full"), F.col("weight")).otherwise(0)).over(whole),
    })
    part = F.expr("cast((budget - taken) * weight div open as decimal(38,0))")
    share = F.when(F.col("full"), F.col("capacity")).when(live, F.least(part, "capacity")).otherwise(0)
    return filled.withColumn("share", share.cast("long")).drop("key", "before", "rest", "full", "taken", "open")


def budgets(leaves: DataFrame, weights: DataFrame, total: Column, epochs: int = EPOCHS) -> DataFrame:
    """``leaves(domain, lang, source, tokens)``, ``weights(level, name, weight)`` -> leaves with
    ``budget``. ``total`` is a column over the sum of all tokens, ``all_tokens``."""
    known = weights.select("level", F.col("name").alias("_name"), F.greatest(F.col("weight").cast("long"), F.lit(0)).alias("_weight"))
    leaves = leaves.withColumn("capacity", F.col("tokens").cast(BIG) * epochs)
    above = leaves.agg(F.sum("tokens").alias("all_tokens")).select(total.cast("long").alias("budget"))
    parent: list[str] = []
    for level in LEVELS:
        path = [*parent, level]
        nodes = leaves.groupBy(*path).agg(F.sum("capacity").alias("capacity"))
        own = known.filter(F.col("level") == level).groupBy("_name").agg(F.max("_weight").alias("_weight"))
        nodes = nodes.join(own, nodes[level] == own["_name"], "left").select(*path, "capacity", F.coalesce("_weight", F.lit(1)).alias("weight"))
        nodes = nodes.join(above, parent) if parent else nodes.join(F.broadcast(above))  # one row
        # one row a node: written, so that the next level's plan begins anew
        above = saved(split_budget(nodes, parent, level).select(*path, F.col("share").alias("budget")))
        parent = path
    return leaves.join(above, list(LEVELS)).select(*LEVELS, "tokens", "budget")


def mix(
    docs: DataFrame, weights: DataFrame, total: Column, epochs: int = EPOCHS, seed: int = SEED, slice_digits: int = SLICE_DIGITS
) -> DataFrame:
    """``docs(doc_id, domain, lang, source, text)`` -> the chosen documents: doc_id, domain,
    lang, source, n_tokens, copies (how often each is taken)."""
    name = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("unknown")).alias(c)
    # texts are read once; the tree needs the counts at every level
    slim = saved(docs.select("doc_id", *(name(c) for c in LEVELS), token_count(F.col("text")).alias("n_tokens")))
    leaves = saved(slim.groupBy(*LEVELS).agg(F.sum("n_tokens").alias("tokens")))
    plan = budgets(leaves, weights, total, epochs).select(
        *LEVELS,
        F.expr("case when tokens > 0 then budget div tokens else 0 end").alias("whole"),
        F.expr("case when tokens > 0 then budget % tokens else 0 end").alias("rest"),
    )
    key = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("whole").cast("string"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))))
    # joined by leaf and salt: by leaf alone the whole of it would lie in one task, and stay there
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
    salted = slim.withColumn("_salt", F.pmod(F.xxhash64("doc_id", "n_tokens"), F.lit(SALTS)).cast("int"))
    placed = salted.join(plan.withColumn("_salt", salts), [*LEVELS, "_salt"]).withColumn("place", key).withColumn("slice", F.substring("place", 1, slice_digits))
    leaf = list(LEVELS)
    sums = placed.groupBy(*leaf, "slice").agg(F.sum("n_tokens").alias("sum"))
    before = Window.partitionBy(*leaf).orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(*leaf, "slice", F.coalesce(F.sum("sum").over(before), F.lit(0)).alias("before"))
    inside = Window.partitionBy(*leaf, "slice").orderBy("place", "n_tokens").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    running = placed.withColumn("run", F.sum("n_tokens").over(inside)).join(sums, [*leaf, "slice"])
    reached = (F.col("run") + F.col("before") <= F.col("rest")) & (F.col("n_tokens") > 0)
    out = running.withColumn("copies", F.col("whole") + reached.cast("long")).filter("copies > 0")
    return out.select("doc_id", *LEVELS, "n_tokens", "copies")
