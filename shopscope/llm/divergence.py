"""Source divergence audit by iceberg prefix refinement (operator 11).

Which terms set a source apart from its language, and how far apart the sources of a language are. Terms are runs of letters
(A-Z lower-cased, all beyond ASCII as it is). A language keeps the terms that at least ``least`` of its documents hold:

1. *Local counts.* Tasks cut texts into terms and put out (lang, term, documents, occurrences by source), summed over a slice of texts. A document is one row
   and lies in one slice, so documents add up without ever naming them.
2. *Iceberg refinement.* A prefix is held by at least as many documents as any term that begins with it. The first level counts documents per prefix of four bytes and
   discards prefixes below ``least``; each level doubles the length and counts only below the prefixes that the level before kept. A zero byte ends each term,
   so a prefix that holds one is a complete term and its count is exact. Levels end when no open prefix is left: after two or three for words, after
   log2(length / 4) for long strings; junk that occurs once leaves at the level at which it differs, by a prefix instead of its whole.
3. *Shares.* Only kept terms are counted by source. With N occurrences and V kept terms, a term of a group has
   ``p = 1 + floor(scale * (count + 1) / (N + V))``, in whole numbers.
4. *Divergence.* ``f(p, q) = floor((p - q) ** 2 / q)``. Terms that a source does not hold all have the same p, so
   the sum over all V terms for two sources is taken over what each of them holds: by the numbers of terms of each count, and corrected for
   the terms that both hold. No table of V terms times all sources is made.

Null text, lang and source are taken as ''. Groups without terms are listed against the other sources; with no kept term every value is 0. Ties
in value are in order of the item. Repeated rows are documents of their own. A term of any length is one value. Empty tables give no rows.
Columns beside text, lang and source are not read. The result holds a row per ordered pair of sources of a language.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from shopscope.llm.text import Words, distinct_spans, slices, small_batches, span_bytes
from shopscope.session import stored

LEAST = 3
SCALE = 1_000_000_000
TOP = 200
FIRST = 4
SLICE = 8 << 20
#: Open prefixes of up to so many bytes (64 for each of them and its own) are sent to all tasks.
MOST_SENT = 32 << 20
END = b"\x00"

#: Bytes that are no part of a term.
NO_TERM = np.ones(256, bool)
NO_TERM[65:91] = NO_TERM[97:123] = NO_TERM[128:] = False


def _local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents per (lang, term) of a slice, and occurrences by source."""
    for rows in slices(batches, limit=SLICE):
        words = Words(rows.column("text"), space=NO_TERM)
        if not len(words):
            continue
        first, which = distinct_spans(words.buf, words.starts, words.ends)
        langs, sources = (rows.column(c).dictionary_encode() for c in ("lang", "source"))
        lang, source = (c.indices.to_numpy().astype(np.int64) for c in (langs, sources))
        # Terms of a document once each, then by language, term and source.
        pairs, times = np.unique(words.text_of * len(first) + which, return_counts=True)
        doc, term = np.divmod(pairs, len(first))
        keys = (lang[doc] * len(first) + term) * len(sources.dictionary) + source[doc]
        order = np.argsort(keys, kind="stable")
        keys = keys[order]
        edge = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        n = np.add.reduceat(times[order], edge)
        named, of = np.divmod(keys[edge], len(sources.dictionary))
        row = np.flatnonzero(np.concatenate([[True], named[1:] != named[:-1]]))
        bounds = pa.array(np.append(row, len(named)).astype(np.int32))
        held = np.diff(np.append(edge[row], len(keys)))
        lang, term = np.divmod(named[row], len(first))
        start, length = words.starts[first][term], (words.ends - words.starts)[first][term]
        ends = np.concatenate([[0], np.cumsum(length)]).astype(np.int64)
        terms = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(term), [None, pa.py_buffer(ends), pa.py_buffer(span_bytes(words.buf, start, length))])
        yield pa.record_batch(
            [langs.dictionary.take(pa.array(lang)), pc.cast(terms, pa.binary()), pa.array(held),
             pa.ListArray.from_arrays(bounds, sources.dictionary.take(pa.array(of))), pa.ListArray.from_arrays(bounds, pa.array(n))],
            ["lang", "term", "docs", "sources", "counts"])


def named(docs: DataFrame) -> DataFrame:
    """lang, source and text without nulls."""
    return docs.select(*(F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("lang", "source", "text")))


def local_counts(docs: DataFrame) -> DataFrame:
    small_batches(docs.sparkSession)
    return stored(named(docs).mapInArrow(_local, "lang string, term binary, docs long, sources array<string>, counts array<long>"), "local_counts")


def kept_terms(local: DataFrame, least: int = LEAST, first: int = FIRST, most_sent: int = MOST_SENT) -> DataFrame:
    """(lang, term) that at least ``least`` documents of the language hold, by refinement of prefixes. Runs a job a level.

    Open prefixes beyond ``most_sent`` bytes meet the terms in a shuffle, where each task holds its part of them.
    """
    ended = local.select("lang", F.concat("term", F.lit(END)).alias("term"), "docs")
    kept, alive, width = [], None, first
    while True:
        rows = ended
        if alive is not None:
            open_ones = alive.select(F.col("lang").alias("l"), F.col("prefix").alias("open"))
            open_ones = F.broadcast(open_ones) if 64 * left.n + left.size <= most_sent else open_ones.hint("shuffle_hash")
            rows = ended.filter(F.length("term") > width // 2).join(
                open_ones, (F.col("lang") == F.col("l")) & (F.expr(f"substring(term, 1, {width // 2})") == F.col("open")), "left_semi")
        level = stored(rows.groupBy("lang", F.expr(f"substring(term, 1, {width})").alias("prefix")).agg(
            F.sum("docs").alias("docs")).filter(F.col("docs") >= least), "prefixes")
        complete = F.expr("substring(prefix, -1, 1)") == F.lit(END)
        kept.append(level.filter(complete).select("lang", F.expr("substring(prefix, 1, length(prefix) - 1)").alias("term")))
        alive = level.filter(~complete)
        left = alive.agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("prefix")).alias("size")).first()
        if not left.n:
            break
        width *= 2
    return reduce(DataFrame.union, kept)


def share(count: Column, total: Column, scale: int) -> Column:
    """1 + floor(scale * (count + 1) / total), exact beyond 64 bits."""
    wide = F.lit(scale).cast("decimal(18,0)") * (count + 1).cast("decimal(19,0)")
    return F.call_function("div", wide, total.cast("decimal(19,0)")) + 1


def apart(p: Column, q: Column) -> Column:
    """floor((p - q) ** 2 / q); shares are at most ``scale`` + 1, so squares fit a long."""
    return F.call_function("div", (p - q) * (p - q), q)


def profiles(local: DataFrame, groups: DataFrame, kept: DataFrame, scale: int) -> tuple[DataFrame, DataFrame]:
    """(sources, terms): (lang, source, held, v, total, none) of every group, and (lang, term, q, of: [(source, n, p, none)]) of every kept term.

    ``total`` is N + V, ``none`` the share of a term that the group does not hold, ``held`` how many it does.
    """
    vocabulary = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("v"))
    # The kept terms are unique and spread by hash; a task holds its part of them, and the local counts need no sort.
    found = local.join(kept.hint("shuffle_hash"), ["lang", "term"]).select("lang", "term", F.inline(F.arrays_zip(F.col("sources").alias("source"), F.col("counts").alias("n"))))
    counts = stored(found.groupBy("lang", "term", "source").agg(F.sum("n").alias("n")), "term_counts")
    per = stored(counts.groupBy("lang", "source").agg(F.sum("n").alias("size"), F.count(F.lit(1)).alias("held")), "held")
    sources = groups.join(vocabulary, "lang").join(per, ["lang", "source"], "left").select(
        "lang", "source", F.coalesce("held", F.lit(0)).alias("held"), "v", (F.coalesce("size", F.lit(0)) + F.col("v")).alias("total"))
    sources = stored(sources.withColumn("none", share(F.lit(0).cast("long"), F.col("total"), scale)), "sources")
    # A row per language, of known size: without it the terms would be dealt out by language.
    whole = stored(per.groupBy("lang").agg(F.sum("size").alias("size")).join(vocabulary, "lang").select(
        F.col("lang").alias("l"), (F.col("size") + F.col("v")).alias("lang_total")), "languages")
    one = F.struct("source", "n", share(F.col("n"), F.col("total"), scale).alias("p"), "none")
    terms = counts.join(sources, ["lang", "source"]).groupBy("lang", "term").agg(F.sum("n").alias("n"), F.collect_list(one).alias("of"))
    terms = terms.join(whole, F.col("lang") == F.col("l")).select("lang", "term", share(F.col("n"), F.col("lang_total"), scale).alias("q"), "of")
    return sources, stored(terms, "terms")


def telling_terms(terms: DataFrame, top: int = TOP) -> DataFrame:
    """The terms that a source holds above its language's share, ranked by divergence."""
    rows = terms.select("lang", F.col("term").cast("string").alias("item"), "q", F.explode("of").alias("x")).filter("x.p > q").select(
        "lang", F.col("x.source").alias("source"), "item", apart(F.col("x.p"), F.col("q")).alias("value"))
    order = W.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return rows.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)


def distances(groups: DataFrame, sources: DataFrame, terms: DataFrame) -> DataFrame:
    """(lang, source, item, value) for every two sources of a language."""
    side = sources.select(F.col("lang").alias("l"), F.col("source").alias("item"), F.col("none").alias("other"), F.col("held").alias("other_held"))
    # Neither holds the term.
    f0 = apart(F.col("none"), F.col("other"))
    both = (F.col("lang") == F.col("l")) & (F.col("source") != F.col("item"))
    neither = sources.join(side, both).select("lang", "source", "item", ((F.col("v") - F.col("held") - F.col("other_held")) * f0).alias("value"))
    # One of them does, by the number of terms of each share, as if the other did not.
    shares = terms.select("lang", F.explode("of").alias("x")).groupBy("lang", "x.source", "x.p").agg(F.count(F.lit(1)).alias("times"))
    paired = shares.join(side, both)
    there = paired.select("lang", "source", "item", (F.col("times") * apart(F.col("p"), F.col("other"))).alias("value"))
    back = paired.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), (F.col("times") * apart(F.col("other"), F.col("p"))).alias("value"))
    # Both do: put that right.
    two = terms.filter(F.size("of") > 1).select("lang", F.explode("of").alias("x"), "of").select("lang", "x", F.explode("of").alias("y")).filter("x.source != y.source")
    p, q, p0, q0 = (F.col(c) for c in ("x.p", "y.p", "x.none", "y.none"))
    shared = two.select("lang", F.col("x.source").alias("source"), F.col("y.source").alias("item"),
                        (apart(p, q) - apart(p, q0) - apart(p0, q) + apart(p0, q0)).alias("value"))
    shared = shared.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    summed = neither.union(there).union(back).union(shared).groupBy("lang", "source", "item").agg(F.sum(F.col("value").cast("decimal(38,0)")).cast("long").alias("value"))
    # Languages that keep no term.
    empty = groups.join(sources.select("lang").distinct(), "lang", "left_anti")
    others = empty.select(F.col("lang").alias("l"), F.col("source").alias("item"))
    return summed.union(empty.join(others, both).select("lang", "source", "item", F.lit(0).cast("long").alias("value")))


def audit(docs: DataFrame, least: int = LEAST, scale: int = SCALE, top: int = TOP) -> DataFrame:
    """(lang, source, part, item, value, rank): part ``pair`` lists the other sources, part ``term`` the telling terms. Runs jobs."""
    local = local_counts(docs)
    groups = stored(named(docs).select("lang", "source").distinct(), "groups")
    kept = kept_terms(local, least)
    sources, terms = profiles(local, groups, kept, scale)
    pairs = distances(groups, sources, terms)
    ranked = pairs.withColumn("rank", F.row_number().over(W.partitionBy("lang", "source").orderBy(F.desc("value"), "item")))
    columns = ["lang", "source", "part", "item", "value", "rank"]
    return ranked.withColumn("part", F.lit("pair")).select(columns).union(telling_terms(terms, top).withColumn("part", F.lit("term")).select(columns))
