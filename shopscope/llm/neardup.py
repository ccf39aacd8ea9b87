"""Near-duplicate documents by HyperMinHash (operator 9).

Texts are lower-cased (A-Z), cut into words ``[^\\x20\\x09-\\x0D]+`` and turned into
sets of distinct five-word shingles, as 64-bit hashes. Documents with the same set form
one class and are handled once. Per class:

1. *Sketch.* The top bits of a hash pick one of 256 buckets; the least rest in a bucket is kept as its count of
   leading zeros and ten mantissa bits, 16 bits a register.
2. *Bands.* Bands of so many registers that two sets at the threshold share no band with a chance of at most 4e-5: 32 bands of 8
   at 0.85 (4e-5; 1e-8 for sets at 0.9), 42 of 6 at 0.8 (3e-6). Classes that agree in a band come into one cluster. For banding, an empty
   register borrows the value of another one, by a fixed pseudo-random order of its own, so a band of a short
   text also samples that many shingles and not one.
3. *Estimate.* In a cluster, pairs whose collision-corrected estimate (of the registers as they were, without loans) is not six
   deviations below the threshold, and whose set sizes allow it, are candidates.
4. *Verify.* Candidates are compared on their full sets, unless links already found join them.

A cluster is dealt out as pairs of blocks of about ``block`` classes and ``SHINGLES * block`` shingles, or one long text; a task holds one pair of blocks and
returns at most a spanning forest of the links in it, so neither a task nor the rows grow with the square of
a group. Nothing is capped: every candidate is in one pair of blocks.

Texts of any length are taken whole, in slices of about a megabyte or one text. Null or empty texts have an empty set and are linked with nothing. Rows are identified by doc_id: repeated rows
of one id are one document if their texts agree, and are classed each by its own text if not. A null doc_id takes part, but is not the least of a
component unless all ids in it are null. Of the classes that hold the least id of a component, the least class is kept.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopscope.llm.graph import components
from shopscope.llm.text import Words, binary_rows, distinct_sets, list_rows, mix, shingles, slices, small_batches
from shopscope.session import stored

REGISTERS = 256
MISS = 4e-5
EMPTY = np.uint16(0xFFFF)
MANTISSA = 10
BLOCK = 1536
#: Shingles a block holds for each set of ``BLOCK``: 6 MB of hashes at most, or one set.
SHINGLES = 512
#: Keys of rows that are sent to every task; more are joined by a shuffle.
MOST_KEYS = 2_000_000
THRESHOLD = 85  # in hundredths


def sketch(values: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    """HyperMinHash registers (n x 256) of sorted sets: zeros counted and mantissa of each bucket's least hash."""
    regs = np.full((n, REGISTERS), EMPTY, np.uint16)
    bucket = (values >> np.uint64(56)).astype(np.int64)
    slot = owner * REGISTERS + bucket
    first = np.ones(len(slot), bool)
    first[1:] = slot[1:] != slot[:-1]
    rest = np.maximum(values[first] & np.uint64((1 << 56) - 1), np.uint64(1)).astype(np.float64)
    # A double's exponent counts the leading zeros; the bits after it are the mantissa.
    packed = (rest.view(np.uint64) >> np.uint64(52 - MANTISSA)) - np.uint64(1023 << MANTISSA)
    regs.reshape(-1)[slot[first]] = packed.astype(np.uint16)
    return regs


#: Where an empty register looks for a value: row t has its t-th choice for each register.
LOANS = np.random.default_rng(20240301).integers(0, REGISTERS, (4096, REGISTERS))


def lend(regs: np.ndarray) -> np.ndarray:
    """Registers with the empty ones of non-empty sketches filled by loans."""
    out = regs.copy()
    row, reg = np.nonzero((regs == EMPTY) & (regs != EMPTY).any(1)[:, None])
    for choice in LOANS:
        if not len(row):
            return out
        value = regs[row, choice[reg]]
        got = value != EMPTY
        out[row[got], reg[got]] = value[got]
        row, reg = row[~got], reg[~got]
    for r, k in zip(row.tolist(), reg.tolist()):  # a chance below 1e-4 for a single shingle: the next filled one
        out[r, k] = np.roll(regs[r], -k)[np.roll(regs[r], -k) != EMPTY][0]
    return out


def band_width(percent: int) -> int:
    """Registers in a band: the most with which sets at the threshold miss each other with a chance of ``MISS`` or less."""
    fits = [b for b in range(1, REGISTERS + 1) if (1 - (percent / 100) ** b) ** (REGISTERS // b) <= MISS]
    return max(fits, default=1)


def band_keys(regs: np.ndarray, band: int) -> np.ndarray:
    """A 64-bit key for each band of each sketch, loans included."""
    count = REGISTERS // band
    padded = np.zeros((len(regs), count, -(-band // 4) * 4), np.uint16)
    padded[:, :, :band] = lend(regs)[:, :count * band].reshape(len(regs), count, band)
    halves = padded.view(np.uint64)
    keys = np.zeros(halves.shape[:2], np.uint64) + np.arange(1, halves.shape[1] + 1, dtype=np.uint64)
    for k in range(halves.shape[2]):
        keys = mix(keys ^ halves[:, :, k])
    return keys


def set_keys(values: np.ndarray, owner: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Size and 128-bit digest of each set: two sums over differently mixed values, mixed with the size."""
    sizes = np.bincount(owner, minlength=n)
    bounds = np.concatenate([[0], np.cumsum(sizes)])
    digest = np.zeros((n, 2), np.uint64)
    for k, salt in enumerate((0x243F6A8885A308D3, 0x13198A2E03707344)):
        sums = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(mix(values ^ np.uint64(salt)), out=sums[1:])
        digest[:, k] = mix(sums[bounds[1:]] - sums[bounds[:-1]] + np.uint64(salt) * sizes.astype(np.uint64))
    return sizes, digest


def key_rows(digest: np.ndarray) -> pa.Array:
    return binary_rows(digest.reshape(-1), np.full(len(digest), 2))


def _sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for piece in slices(batches):
        n = piece.num_rows
        values, owner = distinct_sets(*shingles(Words(piece.column("text"))))
        sizes, digest = set_keys(values, owner, n)
        regs = sketch(values, owner, n)
        yield pa.record_batch(
            [piece.column("doc_id"), piece.column("text_hash"), pa.array(sizes), key_rows(digest), binary_rows(regs.reshape(-1), np.full(n, REGISTERS))],
            ["doc_id", "text_hash", "n_shingles", "class", "registers"])


def _keyed_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for piece in slices(batches):
        values, owner = distinct_sets(*shingles(Words(piece.column("text"))))
        sizes, digest = set_keys(values, owner, piece.num_rows)
        yield pa.record_batch([key_rows(digest), binary_rows(values, sizes)], ["class", "shingles"])


def _bands(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            regs = np.stack([np.frombuffer(r, np.uint16) for r in batch.column("registers").to_pylist()]) if batch.num_rows else np.zeros((0, REGISTERS), np.uint16)
            keys = band_keys(regs, band_width(percent))
            yield pa.record_batch(
                [batch.column("class"), list_rows(keys.reshape(-1).view(np.int64), np.full(len(keys), keys.shape[1]))], ["class", "bands"])

    return run


def estimate(same: np.ndarray, filled: np.ndarray, size_a: np.ndarray, size_b: np.ndarray) -> np.ndarray:
    """Jaccard estimate from equal and filled registers, less the equalities that chance gives.

    Chance: 0.169919 * 2 ** (p - r) * 4x / (1 + x) ** 2 of 2 ** p registers, x the ratio of the sizes.
    """
    ratio = size_a / size_b
    chance = 0.169919 * 2.0 ** -MANTISSA * 4 * ratio / (1 + ratio) ** 2
    return (same / filled - chance) / (1 - chance)


def forest(sizes: np.ndarray, regs: np.ndarray, sets: list[np.ndarray], side: np.ndarray, percent: int = THRESHOLD) -> list[tuple[int, int]]:
    """Links that join the members of two blocks, at most one fewer than there are members.

    ``side`` is 0 or 1, the block of each member; only pairs across are looked at, or, if all are on side 0, all pairs.
    """
    n = len(sizes)
    parent = np.arange(n)

    def root(k: int) -> int:
        while parent[k] != k:
            parent[k] = parent[parent[k]]
            k = parent[k]
        return k

    names, ids = np.unique(np.concatenate(sets) if n else np.zeros(0, np.uint64), return_inverse=True)
    bounds = np.concatenate([[0], np.cumsum([len(s) for s in sets])])
    mark = np.zeros(len(names), bool)
    filled = regs != EMPTY
    left = np.flatnonzero(side == 0)
    across = bool((side == 1).any())
    found = []
    for k in left:
        others = np.flatnonzero(side == 1) if across else left[left > k]
        a, b = sizes[k], sizes[others]
        others = others[100 * np.minimum(a, b) >= percent * np.maximum(a, b)]
        if not len(others):
            continue
        used = (filled[others] | filled[k]).sum(1)
        same = ((regs[others] == regs[k]) & filled[k]).sum(1)
        bar = percent / 100
        slack = 6 * np.sqrt(bar * (1 - bar) / used)
        others = others[estimate(same, used, a, sizes[others]) >= bar - slack]
        others = np.array([o for o in others if root(o) != root(k)], np.int64)
        if not len(others):
            continue
        mark[ids[bounds[k]:bounds[k + 1]]] = True
        spans = [ids[bounds[o]:bounds[o + 1]] for o in others]
        starts = np.concatenate([[0], np.cumsum([len(s) for s in spans])[:-1]])
        common = np.add.reduceat(mark[np.concatenate(spans)].astype(np.int64), starts)
        mark[ids[bounds[k]:bounds[k + 1]]] = False
        union = a + sizes[others] - common
        for o in others[100 * common >= percent * union]:
            if root(o) != root(k):
                parent[root(o)] = root(k)
                found.append((int(k), int(o)))
    return found


def _forests(percent: int):
    def run(rows: pa.Table) -> pa.Table:
        sizes = rows.column("n_shingles").to_numpy()
        keys = rows.column("class").to_pylist()
        regs = np.stack([np.frombuffer(r, np.uint16) for r in rows.column("registers").to_pylist()])
        sets = [np.frombuffer(s, np.uint64) for s in rows.column("shingles").to_pylist()]
        found = forest(sizes, regs, sets, rows.column("side").to_numpy(), percent)
        return pa.table({"a": pa.array([keys[x] for x, _ in found], pa.binary()), "b": pa.array([keys[y] for _, y in found], pa.binary())})

    return run


def text_hash() -> F.Column:
    """Tells the texts of a repeated or null doc_id apart."""
    return F.xxhash64("text")


def of_rows(texts: DataFrame, keys: DataFrame, how: str, most: int = MOST_KEYS) -> DataFrame:
    """Join of ``texts`` with rows named by (id, hash) in ``keys``, a stored table.

    Up to ``most`` keys (24 bytes each) are sent to the texts; beyond that the texts are dealt out, to the same result.
    """
    if keys.count() <= most:
        keys = F.broadcast(keys)
    return texts.join(keys, F.col("doc_id").eqNullSafe(F.col("id")) & F.col("text_hash").eqNullSafe(F.col("hash")), how)


def near_duplicates(docs: DataFrame, percent: int = THRESHOLD, block: int = BLOCK, most_keys: int = MOST_KEYS) -> DataFrame:
    """(doc_id, text_hash, n_shingles, class, component_id, kept) per row of ``docs``. Runs jobs.

    Documents are linked if 100 * intersection >= percent * union of their shingle sets.
    """
    small_batches(docs.sparkSession)
    texts = docs.select("doc_id", "text", text_hash().alias("text_hash"))
    sketched = stored(texts.mapInArrow(_sketches, "doc_id long, text_hash long, n_shingles long, class binary, registers binary"), "sketches")
    # The row that stands for a class; a null id does, too.
    row = F.min(F.struct(F.col("doc_id").alias("id"), F.col("text_hash").alias("hash"))).alias("row")
    classes = stored(sketched.filter("n_shingles > 0").groupBy("class").agg(
        F.first("n_shingles").alias("n_shingles"), F.first("registers").alias("registers"), F.min("doc_id").alias("first_id"), row), "classes")

    banded = classes.select("class", "registers").mapInArrow(_bands(percent), "class binary, bands array<long>").select(
        "class", F.explode("bands").alias("band"))
    least = banded.groupBy("band").agg(F.min("class").alias("least"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
    shared = banded.join(least, "band").select(F.col("class").alias("a"), F.col("least").alias("b"))
    clusters = stored(components(shared).select(F.col("node").alias("class"), F.col("root").alias("cluster")), "clusters")

    # Block numbers within a cluster come from the class digest; a pair of blocks is one task's work, bounded in sets and in shingles.
    sized = clusters.join(classes.select("class", "n_shingles"), "class")
    counts = sized.groupBy("cluster").agg(F.greatest(
        F.ceil(F.count(F.lit(1)) / F.lit(block)), F.ceil(F.sum("n_shingles") / F.lit(block * SHINGLES))).cast("int").alias("blocks"))
    # Clusters of one block, nearly all, need no look-up; the few others are sent along as far as their number is bounded.
    large = stored(counts.filter("blocks > 1"), "large_clusters")
    if large.count() <= most_keys:
        large = F.broadcast(large)
    placed = clusters.join(large, "cluster", "left").fillna({"blocks": 1}).withColumn("own", F.pmod(F.xxhash64("class"), F.col("blocks")).cast("int"))
    members = stored(placed.join(classes, "class").select("class", "cluster", "blocks", "own", "n_shingles", "registers", "row"), "members")
    # One document stands for its class; only its text is read again.
    keys = stored(members.select("row.id", "row.hash").distinct(), "stand_ins")
    sets = of_rows(texts, keys, "left_semi", most_keys).select("text").mapInArrow(_keyed_sets, "class binary, shingles binary").groupBy("class").agg(
        F.first("shingles").alias("shingles"))
    full = members.drop("row").join(sets, "class")
    dealt = full.select("*", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")).select(
        "class", "n_shingles", "registers", "shingles", "cluster",
        F.least("own", "other").alias("one"), F.greatest("own", "other").alias("two"),
        F.when(F.col("own") <= F.col("other"), 0).otherwise(1).cast("int").alias("side"))
    links = dealt.groupBy("cluster", "one", "two").applyInArrow(_forests(percent), "a binary, b binary")
    joined = components(links)

    named = classes.select("class", "first_id").join(joined, F.col("class") == F.col("node"), "left").select(
        "class", "first_id", F.coalesce("root", "class").alias("root"))
    # Nulls last: the least id that is one, then the least class with it.
    least_one = F.min(F.struct(F.col("first_id").isNull(), F.col("first_id").alias("id"), F.col("class").alias("class")))
    smallest = named.groupBy("root").agg(least_one.alias("one")).select("root", F.col("one.id").alias("component_id"), F.col("one.class").alias("keeper"))
    by_class = named.join(smallest, "root").select(F.col("class").alias("of"), "component_id", "keeper")
    result = sketched.drop("registers").join(by_class, F.col("class") == F.col("of"), "left")
    component = F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("component_id"))
    keeper = (F.col("n_shingles") == 0) | (F.col("class") == F.col("keeper"))
    return result.select("doc_id", "text_hash", "n_shingles", "class", component.alias("component_id"), keeper.alias("keeper")).withColumn(
        "kept", F.col("doc_id").eqNullSafe(F.col("component_id")) & F.col("keeper")).drop("keeper")


def without_near_duplicates(docs: DataFrame, percent: int = THRESHOLD, most_keys: int = MOST_KEYS) -> DataFrame:
    """The rows of ``docs``, all columns, that are kept: rows are told apart by doc_id, nulls included, and text. Runs jobs."""
    # Rows to drop are fewer than rows to keep, and a row without a verdict stays.
    gone = near_duplicates(docs, percent, most_keys=most_keys).filter("NOT kept").select(F.col("doc_id").alias("id"), F.col("text_hash").alias("hash")).distinct()
    # One struct holds the columns of the documents, whatever their names.
    rows = docs.select("doc_id", text_hash().alias("text_hash"), F.struct("*").alias("row"))
    return of_rows(rows, stored(gone, "gone"), "left_anti", most_keys).select("row.*")
