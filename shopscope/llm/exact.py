"""Exact duplicates by content-defined chunk recipes (operator 7).

A text is cut where a rolling hash of 48 bytes hits a pattern, so equal passages give
equal chunks wherever they stand. A chunk is named by a 64-bit digest. One grouped pass
over (digest, bytes) verifies the names: a digest that stands for two different byte strings is
a collision, and chunks with such a digest are also numbered among the strings that share it. A document is then
its ordered list of verified names, its recipe, and documents are compared and grouped by these short lists.
Chunk bytes move once, each distinct chunk once per task; recipes of a few numbers move from there on.

Null and empty texts have the empty recipe and are equal to each other. Ids may repeat or be null: every row counts
in its group, the largest non-null id stays, and all rows that carry it are kept. Texts of any length are cut
into chunks of at most ``most`` bytes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from shopscope.llm.text import binary_rows, flat, list_rows, slices, span_hashes, window_sums
from shopscope.session import stored

WINDOW = 48
AVERAGE = 4096
LEAST = 1024
MOST = 32768


def cut(buf: np.ndarray, bounds: np.ndarray, average: int = AVERAGE, least: int = LEAST, most: int = MOST) -> tuple[np.ndarray, np.ndarray]:
    """Ends of the chunks of each text, in order, and the number of chunks of each text."""
    hits = np.flatnonzero(window_sums(buf, WINDOW) < np.uint64(2**64 // average)) + WINDOW
    ends: list[int] = []
    counts = np.zeros(len(bounds) - 1, np.int64)
    for k, (start, stop) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist())):
        before, at = len(ends), start
        # A window that reaches back into the text before this one does not count.
        lo, hi = np.searchsorted(hits, (start + WINDOW, stop))
        for hit in hits[lo:hi].tolist():
            while hit - at > most:
                at += most
                ends.append(at)
            if hit - at >= least:
                at = hit
                ends.append(at)
        while stop - at > most:
            at += most
            ends.append(at)
        if at < stop:
            ends.append(stop)
        counts[k] = len(ends) - before
    return np.array(ends, np.int64), counts


def _chunked(piece: pa.RecordBatch, bits: int):
    buf, bounds = flat(piece.column("text"))
    ends, counts = cut(buf, bounds)
    starts = np.concatenate([[0], ends[:-1]]).astype(np.int64)
    digests = (span_hashes(buf, starts, ends) >> np.uint64(64 - bits)).astype(np.int64)
    return buf, bounds, starts, ends, counts, digests


def _recipes(batches: Iterator[pa.RecordBatch], bits: int) -> Iterator[pa.RecordBatch]:
    for piece in slices(batches):
        buf, bounds, _, _, counts, digests = _chunked(piece, bits)
        view = memoryview(buf.tobytes())
        shas = [hashlib.sha256(view[a:b]).hexdigest() for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())]
        yield pa.record_batch([piece.column("doc_id"), pa.array(shas), list_rows(digests, counts)], ["doc_id", "text_sha256", "recipe"])


def _chunks(batches: Iterator[pa.RecordBatch], bits: int) -> Iterator[pa.RecordBatch]:
    for piece in slices(batches):
        buf, _, starts, ends, _, digests = _chunked(piece, bits)
        # Once per piece: copies within it need not leave the task.
        seen: set[tuple[int, bytes]] = set()
        keep = []
        data = buf.tobytes()
        for k, (d, a, b) in enumerate(zip(digests.tolist(), starts.tolist(), ends.tolist())):
            key = (d, data[a:b])
            if key not in seen:
                seen.add(key)
                keep.append(k)
        if keep:
            lengths = (ends - starts)[keep]
            picked = np.concatenate([buf[starts[k]:ends[k]] for k in keep])
            yield pa.record_batch([pa.array(digests[keep]), binary_rows(picked, lengths)], ["digest", "bytes"])


def _places(batches: Iterator[pa.RecordBatch], bits: int) -> Iterator[pa.RecordBatch]:
    for piece in slices(batches):
        buf, bounds, starts, ends, counts, digests = _chunked(piece, bits)
        data = buf.tobytes()
        shas = [hashlib.sha256(data[a:b]).hexdigest() for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())]
        owner = np.repeat(np.arange(piece.num_rows), counts)
        place = np.arange(len(ends)) - np.repeat(np.cumsum(counts) - counts, counts)
        yield pa.record_batch(
            [pa.array([shas[k] for k in owner], pa.string()), pa.array(place.astype(np.int32)), pa.array(digests),
             binary_rows(buf, ends - starts)], ["of", "place", "digest", "bytes"])


def duplicates(docs: DataFrame, bits: int = 63) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256, recipe) per row. Runs jobs.

    ``bits`` is the length of a digest; tests shorten it to force collisions.
    """
    texts = docs.select("doc_id", "text")
    recipes = stored(texts.mapInArrow(partial(_recipes, bits=bits), "doc_id long, text_sha256 string, recipe array<long>"), "recipes")
    strings = texts.mapInArrow(partial(_chunks, bits=bits), "digest long, bytes binary").groupBy("digest", "bytes").agg(F.lit(1).alias("one"))
    collided = stored(strings.groupBy("digest").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n"), "collided")
    if collided.isEmpty():
        named = recipes.withColumn("variants", F.lit("").cast("string"))
    else:
        named = _numbered(texts, recipes, collided, bits)
    groups = named.groupBy("recipe", "variants").agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    a, g = named.alias("a"), groups.alias("g")
    joined = a.join(g, (F.col("a.recipe") == F.col("g.recipe")) & (F.col("a.variants") == F.col("g.variants")))
    return joined.select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256", "a.recipe")


def _numbered(texts: DataFrame, recipes: DataFrame, collided: DataFrame, bits: int) -> DataFrame:
    """Recipes with the number of each collided chunk among the strings that share its digest.

    The chunk list of a document is found again by the document's own digest, so repeated ids do no harm.
    """
    at = texts.mapInArrow(partial(_places, bits=bits), "of string, place int, digest long, bytes binary").join(collided, "digest")
    strings = at.select("digest", "bytes").distinct()
    numbers = strings.withColumn("number", F.row_number().over(W.partitionBy("digest").orderBy("bytes")))
    placed = at.join(numbers, ["digest", "bytes"]).select("of", "place", "number").distinct()
    variants = placed.groupBy("of").agg(F.array_sort(F.collect_list(F.struct("place", "number"))).cast("string").alias("variants"))
    return recipes.join(variants, F.col("text_sha256") == F.col("of"), "left").select(
        "doc_id", "text_sha256", "recipe", F.coalesce("variants", F.lit("")).alias("variants"))
