"""Mixing sources to token targets by entropy balancing (operator 8).

Every document gets a rate between 0 and ``most``. Rates minimise the bounded
entropy distance from the plain corpus (rate 1) under one constraint per
source: sizes times rates add up to the source's target. The dual of that
problem is convex with one multiplier per source, and its solution is an
exponential tilt, ``rate = most / (1 + (most - 1) * exp(-multiplier * size))``,
sizes in units of the source's mean. Newton steps run as joins and grouped sums
over a table of distinct (source, size) pairs; no multiplier passes through the driver.

Rates become copies by error feedback: within a bucket of one source, in falling
order of size, a document takes the number of copies that brings the words taken
nearest to the sum of sizes times rates so far. What is left over at the end of a
bucket is about half of its smallest document, or up to half of a document that outweighs the rest of its bucket. Buckets are hash ranges of a
source, so a hot source is many buckets and no task holds a whole source.

Nulls: a null text has size 0 (and rate 1, zero words taken); a null source is a
source of its own, ordered last. Empty tables give empty results. Repeated rows
are documents of their own.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from shopscope.session import stored

WEIGHTS = (5.0, 2.0, 1.0)
SHARE = 1.5
MOST = 2
BUCKET_ROWS = 2_000
STEPS = 40


def words_in(text: str) -> F.Column:
    """Number of words ``[^\\x20\\x09-\\x0D]+``; null has none."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """(source, n_docs, source_size, target), one row per source.

    Sources in code point order, nulls last, take the weights in turn. A target stops at ``most`` times its
    source's size; the excess is shared out again by weight. Filling up stops after the sources with the least
    size per weight, so the level is found with running sums instead of rounds: with sources in order of
    ``most * size / weight``, the first k are full, and the level of the rest is what remains over their weight.
    """
    per = sizes.groupBy("source").agg(F.count(F.lit(1)).alias("n_docs"), F.sum("size").alias("source_size"))
    # Sources are few beside documents; one ordered window over them numbers them.
    number = F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1
    pick = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (number % len(weights) + 1).cast("int"))
    per = per.withColumn("weight", pick).withColumn("full", F.lit(float(most)) * F.col("source_size"))
    by_level = W.orderBy(F.col("full") / F.col("weight"), F.col("source").asc_nulls_last())
    before = by_level.rowsBetween(W.unboundedPreceding, -1)
    everything = W.partitionBy()
    budget = F.lit(float(share)) * F.sum("source_size").over(everything)
    left = budget - F.coalesce(F.sum("full").over(before), F.lit(0.0))
    weight_left = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    per = per.withColumn("level", left / weight_left)
    capped = F.col("level") * F.col("weight") >= F.col("full")
    # The first source that is not full fixes the level of all after it.
    per = per.withColumn("settled", F.min(F.when(~capped, F.struct(F.col("full") / F.col("weight"), F.col("level")))).over(everything))
    level = F.col("settled").getField("level")
    per = per.withColumn("target", F.when(F.col("settled").isNull(), F.col("full")).otherwise(
        F.least(F.col("full"), level * F.col("weight"))))
    return per.select("source", "n_docs", "source_size", "target")


def multipliers(sizes: DataFrame, goals: DataFrame, most: float = MOST, steps: int = STEPS, close: float = 1e-9) -> DataFrame:
    """(source, scale, multiplier): Newton on the dual, kept between bounds that close in.

    One job per step over the distinct (source, size) pairs. Steps end when every source is within ``close``
    of its target, relative to its size.
    """
    pairs = stored(sizes.filter("size > 0").groupBy("source", "size").agg(F.count(F.lit(1)).alias("n")), "sizes")
    goals = goals.filter("source_size > 0").withColumn("scale", F.col("source_size") / F.col("n_docs"))
    state = goals.select("source", "scale", "target", "source_size", F.lit(0.0).alias("multiplier"),
                         F.lit(-1e6).alias("low"), F.lit(1e6).alias("high"))
    state = stored(state, "multipliers")
    for _ in range(steps):
        s = state.alias("s")
        joined = pairs.join(s, pairs["source"].eqNullSafe(s["source"]))
        x = F.col("size") / F.col("scale")
        rate = rate_of(F.col("multiplier") * x, most)
        sums = joined.groupBy(F.col("s.source").alias("at")).agg(
            F.sum(F.col("n") * F.col("size") * rate).alias("got"),
            F.sum(F.col("n") * F.col("size") * x * rate * (1 - rate / most)).alias("slope"))
        new = state.join(sums, state["source"].eqNullSafe(sums["at"]))
        over = F.col("got") > F.col("target")
        low, high = F.when(over, F.col("low")).otherwise(F.col("multiplier")), F.when(over, F.col("multiplier")).otherwise(F.col("high"))
        newton = F.col("multiplier") - (F.col("got") - F.col("target")) / F.greatest(F.col("slope"), F.lit(1e-12))
        full = F.col("target") >= most * F.col("source_size") * (1 - 1e-12)
        middle = F.when(low <= -1e6, 2 * high - 1).when(high >= 1e6, 2 * low + 1).otherwise((low + high) / 2)
        step = F.when(full, F.lit(1e6)).when((newton > low) & (newton < high), newton).otherwise(middle)
        off = F.when(full, 0.0).otherwise(F.abs(F.col("got") - F.col("target")) / F.col("source_size"))
        new = new.select("source", "scale", "target", "source_size", F.when(off <= close, F.col("multiplier")).otherwise(step).alias("multiplier"),
                         low.alias("low"), high.alias("high"), off.alias("off"))
        state = stored(new, "multipliers")
        worst = state.agg(F.max("off")).first()[0]
        state = state.drop("off")
        if worst is None or worst <= close:
            break
    # A full source keeps a multiplier beyond any size.
    return state.select("source", "scale", F.when(F.col("target") >= most * F.col("source_size") * (1 - 1e-12), F.lit(1e6)).otherwise(
        F.col("multiplier")).alias("multiplier"))


def rate_of(tilt: F.Column, most: float) -> F.Column:
    return F.lit(float(most)) / (1 + (most - 1) * F.exp(F.least(F.greatest(-tilt, F.lit(-700.0)), F.lit(700.0))))


def round_copies(batches: Iterator[pd.DataFrame], most: int) -> Iterator[pd.DataFrame]:
    """Copies by error feedback over rows sorted by bucket and falling size."""
    bucket, owed = None, 0.0
    for rows in batches:
        copies = []
        for at, size, rate in zip(rows["bucket"], rows["size"], rows["rate"]):
            if at != bucket:
                bucket, owed = at, 0.0
            if size == 0:
                copies.append(1)
                continue
            owed += size * rate
            take = min(most, max(0, int(owed / size + 0.5)))
            owed -= take * size
            copies.append(take)
        yield rows[["doc_id", "text_key", "source", "size", "source_size", "target", "rate"]].assign(copies=copies)


def mix(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, most: int = MOST, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """(doc_id, text_key, source, size, source_size, target, rate, copies, taken) per document.

    ``text_key`` is a hash of the text, for joining documents whose ids repeat. Runs jobs.
    """
    sizes = stored(docs.select("doc_id", F.xxhash64("text").alias("text_key"), "source", words_in("text").alias("size")), "sized")
    goals = stored(targets(sizes, weights, share, most), "targets")
    tilt = multipliers(sizes, goals, most)
    goals = goals.alias("g").join(tilt.alias("t"), F.col("g.source").eqNullSafe(F.col("t.source")), "left").select(
        F.col("g.source").alias("to_source"), "n_docs", "source_size", "target", "scale", "multiplier")
    rate = F.when(F.col("size") == 0, F.lit(1.0)).otherwise(rate_of(F.col("multiplier") * F.col("size") / F.col("scale"), most))
    parts = F.ceil(F.col("n_docs") / F.lit(bucket_rows))
    # Which bucket a document falls into depends on its id and text alone, so reruns agree.
    part = F.pmod(F.xxhash64("doc_id", "text_key"), parts)
    rated = sizes.join(goals, sizes["source"].eqNullSafe(goals["to_source"])).select(
        "doc_id", "text_key", "source", "size", "source_size", "target", rate.alias("rate"),
        F.concat_ws("\u0001", F.coalesce(F.col("source"), F.lit("\u0000")), part).alias("bucket"))
    # Without a source row there is one value per partition count; sort ties by id and text keep reruns equal.
    dealt = rated.repartition("bucket").sortWithinPartitions("bucket", F.col("size").desc(), "doc_id", "text_key")
    copied = dealt.mapInPandas(
        lambda batches: round_copies(batches, most),
        "doc_id long, text_key long, source string, size long, source_size long, target double, rate double, copies int")
    return copied.withColumn("taken", F.col("copies") * F.col("size"))


def mixed(docs: DataFrame, **settings) -> DataFrame:
    """The rows of ``docs``, all columns, each as often as the mix takes it. Runs jobs.

    Rows that share id, text and source are copies of one document: what the mix takes of them is summed and
    given out as that many rows.
    """
    def keys(text_key: F.Column) -> list[F.Column]:
        # Two hashes that are never null, so nulls need no care in the join.
        return [F.xxhash64(F.col("doc_id"), text_key, F.col("source")).alias("__one"),
                F.xxhash64(F.lit(1), F.col("source"), text_key, F.col("doc_id")).alias("__two")]

    taken = mix(docs, **settings).select(*keys(F.col("text_key")), "copies").groupBy("__one", "__two").agg(F.sum("copies").cast("int").alias("__copies"))
    once = docs.select("*", *keys(F.xxhash64("text"))).dropDuplicates(["__one", "__two"])
    times = F.explode(F.array_repeat(F.lit(1), F.col("__copies")))
    return once.join(taken, ["__one", "__two"]).select(*[F.col(f"`{c}`") for c in docs.columns], times.alias("__time")).drop("__time")
