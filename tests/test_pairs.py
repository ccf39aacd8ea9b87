"""Pair counts against brute force, on baskets of every awkward shape."""

import itertools
import re
import random
from collections import Counter

import pytest

from shopscope.operators.pairs import Signal, item_pairs, top_pairs


def baskets(seed, n_baskets, n_items, hot=0, repeats=0.1):
    """Rows (basket, item). The first basket holds ``hot`` extra items."""
    rng = random.Random(seed)
    rows = []
    for b in range(n_baskets):
        items = [min(int(rng.paretovariate(0.8)), n_items) for _ in range(rng.randint(0, 6))]
        rows += [(b, i) for i in items]
        rows += [(b, i) for i in items if rng.random() < repeats]
    rows += [(0, i) for i in range(1, hot + 1)]
    return rows


def brute(rows):
    counts = Counter()
    by_basket = {}
    for b, i in rows:
        if b is not None and i is not None:
            by_basket.setdefault(b, []).append(i)
    for items in by_basket.values():
        for x, y in itertools.product(items, items):
            if x < y:
                counts[x, y] += 1
    return counts


def frame(spark, rows):
    return spark.createDataFrame(rows, "basket bigint, item bigint").repartition(4)


def as_counts(df):
    return {(r[0], r[1]): r[2] for r in df.collect()}


def test_repeats_multiply(spark):
    rows = [(1, 1), (1, 1), (1, 2), (2, None), (None, 1), (None, 2)]
    assert as_counts(item_pairs(frame(spark, rows), "basket", "item")) == {(1, 2): 2}


@pytest.mark.parametrize("block", [3, 16, 1024])
def test_all_pairs(spark, block):
    """A hot basket holds over a third of the rows and is cut into many blocks."""
    rows = baskets(1, 120, 80, hot=80)
    got = as_counts(item_pairs(frame(spark, rows), "basket", "item", block=block))
    assert got == dict(brute(rows))


def expected_top(scores, limit):
    return sorted(scores.items(), key=lambda kv: (-kv[1], kv[0]))[:limit]


@pytest.mark.parametrize("limit,seeds,block", [(1, 2, 4), (10, 5, 4), (10, None, 1024), (25, 8, 7)])
def test_top_pairs(spark, limit, seeds, block):
    rows = baskets(2, 150, 60, hot=60)
    known = spark.createDataFrame([(i,) for i in range(2, 61)], "item bigint")
    signal = Signal(frame(spark, rows), "basket", "item", "n")
    got = [((r.item_a, r.item_b), r.n) for r in top_pairs([signal], known, limit, seeds, block).collect()]
    scores = {p: n for p, n in brute(rows).items() if min(p) >= 2}
    assert got == expected_top(scores, limit)


def test_rare_items_are_dropped(spark):
    rows = baskets(3, 200, 40, repeats=0) + [(0, i) for i in range(100, 400)]
    known = spark.createDataFrame([(i,) for i in range(400)], "item bigint")
    best = top_pairs([Signal(frame(spark, rows), "basket", "item", "n")], known, 3)
    assert [(r.item_a, r.item_b) for r in best.collect()] == [p for p, _ in expected_top(brute(rows), 3)]
    assert re.search(r"bound#\d+ >= [1-9]", best._jdf.queryExecution().optimizedPlan().toString())


def test_wide_basket_forms_no_pairs(spark):
    """A basket of 30,000 items, a third of all rows, has 450 million pairs. It
    adds one to the count of the best and is asked for nothing else."""
    rows = [(b, i) for b in range(1, 15_001) for i in (b % 97, 97 + b % 89, 200 + b % 7, 300 + b % 3)]
    rows += [(0, i) for i in range(30_000)]
    known = spark.createDataFrame([(i,) for i in range(30_000)], "item bigint")
    best = top_pairs([Signal(frame(spark, rows), "basket", "item", "n")], known, 12)
    got = [((r.item_a, r.item_b), r.n) for r in best.collect()]
    counts = brute([r for r in rows if r[0] != 0])
    assert got == expected_top({p: n + 1 for p, n in counts.items()}, 12)


def test_wide_baskets_too_many_to_bound(spark):
    """Wide baskets that could carry a pair on their own are counted in blocks."""
    rows = [(b, i) for b in range(5) for i in range(40)] + [(9, 1), (9, 2)]
    known = spark.createDataFrame([(i,) for i in range(40)], "item bigint")
    best = top_pairs([Signal(frame(spark, rows), "basket", "item", "n")], known, 4, block=8)
    got = [((r.item_a, r.item_b), r.n) for r in best.collect()]
    assert got == [((1, 2), 6), ((0, 1), 5), ((0, 2), 5), ((0, 3), 5)]


def test_many_wide_baskets_form_no_pairs(spark):
    """Sixty wide baskets of 400 items, more than the floor of 50, that share
    two items: only the pair of those two is formed out of five million."""
    rows = [(b, i) for b in range(1, 61) for i in (1, 2, *range(1000 * b, 1000 * b + 398))]
    rows += [(b, i) for b in range(100, 150) for i in (3, 4)] + [(b, i) for b in range(150, 202) for i in (5, 6)]
    known = spark.createDataFrame([(i,) for i in {i for _, i in rows}], "item bigint")
    best = top_pairs([Signal(frame(spark, rows), "basket", "item", "n")], known, 3, block=16)
    assert [((r.item_a, r.item_b), r.n) for r in best.collect()] == [((1, 2), 60), ((5, 6), 52), ((3, 4), 50)]
    assert _most_rows(best) < 2000


def _most_rows(df):
    """The most rows that a join on baskets put out when the plan ran."""
    found, left = 0, [df._jdf.queryExecution().executedPlan()]
    while left:
        node = left.pop()
        if "AdaptiveSparkPlan" in node.nodeName():
            left.append(node.executedPlan())
        if "QueryStage" in node.nodeName():
            left.append(node.plan())
        children = node.children()
        left.extend(children.apply(k) for k in range(children.size()))
        if "Join" in node.nodeName() and "lo#" in node.simpleString(1000):
            found = max(found, node.metrics().apply("numOutputRows").value())
    return found


def test_rounded_scores_rank(spark):
    """Two scores that differ by less than is shown tie, and go by item ids."""
    baskets_ = [(1, 1), (1, 2), (2, 3), (2, 4), (3, 3), (3, 4)]
    known = spark.createDataFrame([(i,) for i in range(5)], "item bigint")
    signal = Signal(frame(spark, baskets_), "basket", "item", "n", 0.001)
    best = top_pairs([signal], known, 1, scale=2).collect()
    assert [(r.item_a, r.item_b, r.score) for r in best] == [(1, 2, 0.0)]


def test_fewer_pairs_than_asked(spark):
    known = spark.createDataFrame([(1,), (2,)], "item bigint")
    rows = frame(spark, [(1, 1), (1, 2), (2, 3)])
    assert top_pairs([Signal(rows, "basket", "item", "n")], known, 10).count() == 1


def test_two_weighted_signals(spark):
    buys, views = baskets(4, 80, 30), baskets(5, 120, 30, hot=30)
    known = spark.createDataFrame([(i,) for i in range(31)], "item bigint")
    views_frame = frame(spark, views).selectExpr("concat('s', basket) as basket", "item")
    signals = [
        Signal(frame(spark, buys), "basket", "item", "bought", 2.5),
        Signal(views_frame, "basket", "item", "viewed", 0.3),
    ]
    got = [((r.item_a, r.item_b), r.bought, r.viewed) for r in top_pairs(signals, known, 15, seeds=6, block=8).collect()]
    b, v = brute(buys), brute(views)
    scores = {p: b[p] * 2.5 + v[p] * 0.3 for p in b.keys() | v.keys()}
    assert got == [(p, b[p], v[p]) for p, _ in expected_top(scores, 15)]


def test_negative_weight_is_refused(spark):
    with pytest.raises(ValueError):
        Signal(frame(spark, [(1, 1)]), "basket", "item", "n", -1.0)
