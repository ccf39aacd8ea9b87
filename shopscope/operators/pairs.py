"""Counting items that occur together.

A pair's count is the number of row pairs of one basket, one holding each item,
so an item listed twice counts twice. What keeps that exact and bounded on
large, skewed input:

* Rows collapse to (basket, item, copies) first. The shuffle is on basket *and*
  item, so a basket holding much of the data is spread over all tasks. The
  result is written once and read by every later step.
* Bags and pairs are nearly as many as the rows that make them, so a task holds
  its share of them all. The jobs that build them run in ``small_tasks``.
* A basket with more than ``block`` distinct items is *wide*. ``item_pairs``,
  whose result is all pairs, cuts it into item blocks and makes every pair of
  blocks its own join key: no key holds more than about ``2 * block`` rows.
* ``top_pairs`` forms pairs of wide baskets among those items only that wide
  baskets alone could lift into the answer, and drops the items that cannot be in
  a leading pair before any pair is formed. It loses nothing: see there.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..session import small_tasks, stored

BLOCK = 1024


@dataclass(frozen=True)
class Signal:
    """Baskets of items that give one pair count, and its weight in the score."""

    rows: DataFrame
    basket: str
    item: str
    name: str
    weight: float = 1.0

    def __post_init__(self):
        if self.weight < 0:
            raise ValueError("a signal's weight must not be negative")


def bags(signals: Sequence[Signal]) -> DataFrame:
    """(signal, basket, item, copies): one row per distinct item of a basket.
    Basket ids of unlike types become text; a union would force one type on
    them."""
    types = {s.rows.schema[s.basket].dataType.simpleString() for s in signals}
    basket_type = types.pop() if len(types) == 1 else "string"
    parts = [
        s.rows.select(
            F.lit(n).alias("signal"),
            F.col(s.basket).cast(basket_type).alias("basket"),
            F.col(s.item).alias("item"),
        ).filter(F.col("basket").isNotNull() & F.col("item").isNotNull())
        for n, s in enumerate(signals)
    ]
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part)
    return rows.groupBy("signal", "basket", "item").agg(F.count("*").alias("copies"))


def special_baskets(bag: DataFrame, block: int = BLOCK) -> DataFrame:
    """Baskets that are wide or repeat an item, with the number of their item
    blocks and their largest multiplicity.

    The list is written, so that the planner knows its size: small, it is
    broadcast; if not, it is shuffled.
    """
    n = F.col("n")
    listed = (
        bag.groupBy("signal", "basket")
        .agg(F.count("*").alias("n"), F.max("copies").alias("most"))
        .filter((n > block) | (F.col("most") > 1))
        .select("signal", "basket", F.ceil(n / block).cast("int").alias("blocks"), "most")
    )
    return stored(listed, "special_baskets")


def with_blocks(bag: DataFrame, special: DataFrame) -> DataFrame:
    """Add ``blocks`` and ``most`` to each row: one, where nothing is listed."""
    return bag.join(special, ["signal", "basket"], "left").fillna({"blocks": 1, "most": 1})


def count_pairs(bag: DataFrame, signals: Sequence[Signal], reach: bool = False) -> DataFrame:
    """(item_a, item_b, one count per signal) with item_a < item_b. With
    ``reach``, also the smaller ``reach`` of the two items."""
    carried = ["reach"] if reach else []
    own = F.pmod(F.xxhash64("item"), F.col("blocks")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    cells = (
        bag.select("signal", "basket", "item", "copies", *carried, own.alias("own"), other.alias("other"))
        .withColumns({"lo": F.least("own", "other"), "hi": F.greatest("own", "other")})
        .drop("other")
    )
    a, b = cells.alias("a"), cells.alias("b")
    key = [F.col(f"a.{c}") == F.col(f"b.{c}") for c in ("signal", "basket", "lo", "hi")]
    # Two items of one block meet in every cell of that block: count them on the diagonal only.
    once = (F.col("a.lo") == F.col("a.hi")) | (F.col("a.own") != F.col("b.own"))
    joined = a.join(b, [*key, F.col("a.item") < F.col("b.item"), once])
    together = joined.select(
        F.col("a.item").alias("item_a"), F.col("b.item").alias("item_b"), F.col("a.signal").alias("signal"),
        (F.col("a.copies") * F.col("b.copies")).alias("copies"),
        *(F.least(f"a.{c}", f"b.{c}").alias(c) for c in carried),
    )
    return _sum_by_pair(together, signals, *(F.max(c).alias(c) for c in carried))


def _sum_by_pair(together: DataFrame, signals: Sequence[Signal], *more: Column) -> DataFrame:
    """Rows (item_a, item_b, signal, copies) summed to one count per signal."""
    return together.groupBy("item_a", "item_b").agg(*(
        F.sum(F.when(F.col("signal") == n, F.col("copies")).otherwise(0)).alias(s.name)
        for n, s in enumerate(signals)
    ), *more)


def _count_in(bag: DataFrame, candidates: DataFrame, signals: Sequence[Signal]) -> DataFrame:
    """What the baskets of ``bag`` add to the given pairs. Every row of a pair's
    first item looks up its second in the same basket; no other pair is formed."""
    first = candidates.select("item_a", "item_b").join(
        bag.select("signal", "basket", F.col("item").alias("item_a"), "copies"), "item_a"
    )
    second = bag.select("signal", "basket", F.col("item").alias("item_b"), F.col("copies").alias("copies_b"))
    together = first.join(second, ["signal", "basket", "item_b"]).select(
        "item_a", "item_b", "signal", (F.col("copies") * F.col("copies_b")).alias("copies")
    )
    return _sum_by_pair(together, signals)


def item_pairs(rows: DataFrame, basket: str, item: str, name: str = "pair_count", block: int = BLOCK) -> DataFrame:
    """All pairs that share a basket, with their counts. Runs jobs."""
    signals = [Signal(rows, basket, item, name)]
    with small_tasks(rows.sparkSession):
        bag = stored(bags(signals), "bags")
        return stored(count_pairs(with_blocks(bag, special_baskets(bag, block)), signals), "pairs")


def score(signals: Sequence[Signal]):
    """Weighted sum of the pair counts."""
    terms = [F.col(s.name) * F.lit(float(s.weight)) for s in signals]
    total = terms[0]
    for t in terms[1:]:
        total = total + t
    return total


def top_pairs(
    signals: Sequence[Signal],
    known: DataFrame,
    limit: int,
    seeds: int | None = None,
    block: int = BLOCK,
    scale: int | None = None,
) -> DataFrame:
    """The ``limit`` best pairs by weighted count, ties by item ids, among the
    items listed in ``known`` (one column, ``item``). With ``scale``, the score is
    rounded to so many places before pairs are ranked.

    The pairs among the ``seeds`` items of highest bound are counted first, and
    their ``limit``-th score is a floor for the answer. It serves three times; the
    plan is the same at every size.

    *Items.* No pair scores above the bound of either of its items, the weighted
    sum of copies times the basket's largest multiplicity. An item whose bound
    lies under the floor can be in no answer pair, and its rows are dropped. On
    skewed data that leaves a small part of the rows.

    *Pairs of other baskets.* The same sum over wide baskets only is an item's
    reach: wide baskets add no more than the smaller reach of its two items to a
    pair. A pair of the other baskets that falls short of the floor by more than
    that is out; the rest look up their count in the wide baskets.

    *Pairs of wide baskets.* A pair that meets in wide baskets only needs two
    items with a reach of the floor at least. Pairs of wide baskets are formed
    among those items only, in blocks.
    """
    if seeds is None:
        seeds = max(64, 2 * math.isqrt(2 * limit) + 1)
    with small_tasks(known.sparkSession):
        return _top_pairs(signals, known, limit, seeds, block, scale)


def _top_pairs(
    signals: Sequence[Signal], known: DataFrame, limit: int, seeds: int, block: int, scale: int | None
) -> DataFrame:
    plain = stored(bags(signals), "bags")
    bag = with_blocks(plain, special_baskets(plain, block))
    wide = F.col("blocks") > 1

    weight = F.element_at(F.array(*(F.lit(float(s.weight)) for s in signals)), F.col("signal") + 1)
    most = F.col("copies") * F.col("most") * weight
    bounds = stored(
        bag.groupBy("item")
        .agg(F.sum(most).alias("bound"), F.sum(F.when(wide, most).otherwise(0.0)).alias("reach"))
        .join(known, "item", "left_semi"),
        "item_bounds",
    )

    seed_items = bounds.orderBy(F.desc("bound"), "item").limit(seeds).select("item")
    seed_scores = (
        count_pairs(bag.join(F.broadcast(seed_items), "item", "left_semi"), signals)
        .select(score(signals).alias("score"))
        .orderBy(F.desc("score"))
        .limit(limit)
    )
    found, lowest = seed_scores.agg(F.count("*"), F.min("score")).first()
    # Just under the exact value, to cover the rounding of fractional weights, and of the score if it is rounded.
    slack = 0.0 if scale is None else 10.0**-scale
    floor = max(0.0, (lowest - slack) * (1 - 1e-9)) if found == limit else 0.0

    bag = bag.join(bounds.filter(F.col("bound") >= floor).select("item", "reach"), "item")
    short = count_pairs(bag.filter(~wide), signals, reach=True).filter(score(signals) + F.col("reach") >= floor)
    # All pairs of the other baskets are counted here, and those that are left are read later.
    short = stored(short, "short_pairs")
    strong = F.col("reach") >= floor
    counts = ["item_a", "item_b", *(s.name for s in signals)]
    total = score(signals) if scale is None else F.round(score(signals), scale)
    ranking = [F.desc("score"), "item_a", "item_b"]
    # An item without reach is in no wide basket (unless a signal weighs nothing): counts of its pairs are final, and the best are enough.
    final = (F.col("reach") == 0) & F.lit(all(s.weight > 0 for s in signals))
    best_final = short.filter(final).withColumn("score", total).orderBy(*ranking).limit(limit)
    parts = [
        best_final.select(*counts),
        short.filter(~final).select(*counts),
        _count_in(bag.filter(wide), short.filter(~strong & (F.col("reach") > 0)), signals),
        count_pairs(bag.filter(wide & strong), signals),
    ]
    pairs = reduce(DataFrame.unionByName, parts).groupBy("item_a", "item_b").agg(
        *(F.sum(s.name).alias(s.name) for s in signals)
    )
    return pairs.withColumn("score", total).orderBy(*ranking).limit(limit)
