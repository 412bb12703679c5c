"""As-of (validity interval) join.

A fact row takes the version of its key that started last on or before its date,
if that version is still valid then; else its attributes are NULL. The range sits
inside the join condition of a LEFT join: a fact without a covering version keeps
its row (filtering after the join would silently drop rows dated before the first
version).

Versions may overlap: a later start supersedes what came before, also after it
has ended itself. Of several versions with one start the one that is valid longest
counts (then the largest attributes). Each fact therefore meets at most one
version, under either strategy:

* ``range`` (default): equi-join on the key with the validity as residual
  condition, as a sort-merge join (the history grows with the catalogue, and the planner
  takes it for as small as the file that its versions and salts are exploded from, so that
  it would broadcast any size); AQE's skew join splits a hot key on the fact side. A
  fact is compared with every version of its key, which suits short histories (a handful
  of cost changes per product).
* ``window``: facts and versions are sorted together, no pairs; for dense histories.

The caller names the strategy; both give the same rows on any input. Helper
columns start with ``_`` (``_k``, ``_t``, ``_s``, ``_p``, ``_kind``, ``_hit``,
``_v_*``, ``_salt``); fact columns must not use them.

``salt > 1`` spreads every key over ``salt`` buckets explicitly: a fact goes to
bucket ``hash(fact columns) mod salt`` (deterministic, so a retried task sends
the row to the same bucket) and the version side is replicated once per
bucket. A key holding a third of the facts then lands in ``salt`` tasks even
where AQE's skew thresholds do not fire; the price is ``salt`` copies of the
(small) version side. Facts that are stored by key and salt already
(``sources.buckets``) name that column as ``salted_by``: they stay where they lie.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

STRATEGIES = ("range", "window")


def timeline(versions: DataFrame, key: str, attrs: Sequence[str], valid_from: str, valid_to: str) -> DataFrame:
    """``_v_key, _v_from, _v_to, _v_next, attrs``: one version per key and start, with
    the next start of the key. A NULL end is open. The window holds one key's versions."""
    known = versions.where(F.col(key).isNotNull() & F.col(valid_from).isNotNull())
    end = F.coalesce(F.col(valid_to), F.lit("9999-12-31").cast(versions.schema[valid_to].dataType))
    packed = F.struct(end.alias("_v_to"), *[F.col(a) for a in attrs])
    one = known.groupBy(F.col(key).alias("_v_key"), F.col(valid_from).alias("_v_from")).agg(F.max(packed).alias("_v"))
    following = F.lead("_v_from").over(Window.partitionBy("_v_key").orderBy("_v_from"))
    return one.select("_v_key", "_v_from", "_v._v_to", following.alias("_v_next"), *[F.col(f"_v.{a}").alias(a) for a in attrs])


def asof_join(
    facts: DataFrame,
    versions: DataFrame,
    key: str,
    on: str,
    attrs: Sequence[str],
    valid_from: str = "valid_from",
    valid_to: str = "valid_to",
    drop_uncovered: bool = False,
    salt: int = 1,
    strategy: str = "range",
    salted_by: str | None = None,
) -> DataFrame:
    """Facts with the ``attrs`` of their version (see the module for the rule). ``salted_by``:
    an int column of the facts, from 0 to below ``salt``; it stays in the result."""
    if strategy not in STRATEGIES:
        raise ValueError(f"strategy must be one of {STRATEGIES}")
    if salted_by and strategy != "range":
        raise ValueError("salted_by belongs to the range strategy")
    v = timeline(versions, key, attrs, valid_from, valid_to)
    if strategy == "window":
        return _window_join(facts, v, key, on, attrs, drop_uncovered, salt)
    f = facts
    if salt > 1 or salted_by:
        v = v.withColumn("_v_salt", F.explode(F.sequence(F.lit(0), F.lit(salt - 1))))
        if not salted_by:
            f = facts.withColumn("_salt", F.pmod(F.xxhash64(*[F.col(c) for c in facts.columns]), F.lit(salt)))
    cond = (
        (f[key] == v["_v_key"])
        & (f[on] >= v["_v_from"])
        & (f[on] <= v["_v_to"])
        & (v["_v_next"].isNull() | (f[on] < v["_v_next"]))
    )
    if salt > 1 or salted_by:
        cond = cond & (f[salted_by or "_salt"] == v["_v_salt"])
    joined = f.join(v.hint("merge"), cond, "inner" if drop_uncovered else "left")
    return joined.drop("_v_key", "_v_from", "_v_to", "_v_next", "_v_salt", "_salt")


def _window_join(
    facts: DataFrame, v: DataFrame, key: str, on: str, attrs: Sequence[str], drop_uncovered: bool, salt: int
) -> DataFrame:
    """As-of join without pairs: facts and versions are sorted together and
    each fact takes the last version started on or before its date.

    Each key is dealt into ``salt`` groups by a hash of the fact; its versions, few beside
    the facts, go into each of them. A group is sorted (on disk where it must be) and read once, and
    the facts are evaluated once: nothing is asked of them before. Facts keep their rows; a fact
    past the end of its version's interval, or with no version, gets NULL attributes."""
    k, d = F.col(key), F.col(on)
    payload = F.struct(F.col("_v_to").alias("_to"), *[F.col(a) for a in attrs])
    fact_cols = facts.columns
    slot = F.pmod(F.xxhash64(*[F.col(c) for c in fact_cols]), F.lit(salt)) if salt > 1 else F.lit(0).cast("bigint")
    slots = F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(salt - 1).cast("bigint")))
    side = v.select(
        F.col("_v_key").alias("_k"), F.col("_v_from").alias("_t"), payload.alias("_p"), slots.alias("_s"), F.lit(1).alias("_kind")
    )
    main = facts.select("*", k.alias("_k"), d.alias("_t"), slot.alias("_s"), F.lit(2).alias("_kind"))
    w = Window.partitionBy("_k", "_s").orderBy("_t", "_kind").rowsBetween(Window.unboundedPreceding, 0)
    found = F.last("_p", ignorenulls=True).over(w)
    merged = main.unionByName(side, allowMissingColumns=True).withColumn("_hit", found)
    out = merged.where(F.col("_kind") == 2)
    covered = F.col("_hit").isNotNull() & (d <= F.col("_hit._to"))
    if drop_uncovered:
        out = out.where(covered)
    return out.select(*fact_cols, *[F.when(covered, F.col(f"_hit.{a}")).alias(a) for a in attrs])
