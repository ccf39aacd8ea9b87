"""Byte-level text helpers for Arrow tasks: words, hashes and windows of many texts at once.

A task sees its texts as one flat byte array with the bounds of each text. Work
goes through slices of a few megabytes, so memory follows the slice (or the
longest single text), not the partition.

Hashes are 64-bit. A word's hash is a polynomial over random byte values,
taken from prefix sums, and mixed; all words of a slice are hashed at once.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from contextlib import suppress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import SparkSession

#: A little under a power of two, so that the tables of ``powers`` are not twice as long as a slice.
SLICE_BYTES = (1 << 20) - 1024
BATCH_BYTES = "8m"


def small_batches(spark: SparkSession) -> None:
    """Lets the session hand texts to Python tasks by 8 MB or less instead of by rows, however long they are."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


#: What the last task of this worker keeps for its next one, by name.
_kept: dict[str, object] = {}


def kept(name: str, make: Callable[[], object]) -> object:
    """An object that tasks of one kind hand on in a worker; ``slices`` of any other kind let it go."""
    if name not in _kept:
        _kept[name] = make()
    return _kept[name]


def give_back() -> None:
    """Free what the worker's allocators hold: a worker lives on with the next stage beside an executor's heap."""
    _powers.clear()
    pa.default_memory_pool().release_unused()
    with suppress(OSError, AttributeError):
        ctypes.CDLL("libc.so.6").malloc_trim(0)


#: White space of the word pattern [^\x20\x09-\x0D]+; these bytes never occur inside a UTF-8 character.
IS_SPACE = np.zeros(256, bool)
IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True

#: A-Z to a-z, all other bytes as they are.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_rng = np.random.default_rng(20240229)
BYTE_VALUE = _rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_STEP = 0x9E3779B97F4A7C15
_BACK = pow(_STEP, -1, 1 << 64)
_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base ** 0 .. base ** (n - 1) modulo 2 ** 64; grown when needed and kept by the worker."""
    known = _powers.get(base)
    if known is None or len(known) < n:
        size = 1 << max(16, (n - 1).bit_length())
        known = np.full(size, base, np.uint64)
        known[0] = 1
        np.multiply.accumulate(known, out=known)
        _powers[base] = known
    return known[:n]


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over all 64 output bits."""
    h = h ^ (h >> np.uint64(30))
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def hash_bytes(text: bytes) -> int:
    """The hash that ``span_hashes`` gives for a span holding these bytes."""
    buf = np.frombuffer(text, np.uint8)
    return int(span_hashes(buf, np.array([0]), np.array([len(buf)]))[0])


def prefix_sums(buf: np.ndarray) -> np.ndarray:
    sums = np.zeros(len(buf) + 1, np.uint64)
    np.cumsum(BYTE_VALUE[buf] * powers(_STEP, len(buf)), out=sums[1:])
    return sums


def span_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of each span of bytes; equal bytes have equal hashes wherever they stand.

    A long array is taken in blocks of about ``SLICE_BYTES``, or of one longer span, so that memory follows the block.
    """
    if len(buf) <= SLICE_BYTES:
        sums = prefix_sums(buf)
        return mix((sums[ends] - sums[starts]) * powers(_BACK, len(buf) + 1)[starts])
    order = np.argsort(starts, kind="stable")
    first, last = starts[order], np.maximum.accumulate(ends[order]) if len(order) else ends
    out = np.empty(len(starts), np.uint64)
    at = 0
    while at < len(order):
        base = int(first[at])
        to = max(at + 1, int(np.searchsorted(last, base + SLICE_BYTES, side="right")))
        some = order[at:to]
        sums = prefix_sums(buf[base:int(last[to - 1])])
        out[some] = mix((sums[ends[some] - base] - sums[starts[some] - base]) * powers(_BACK, len(sums))[starts[some] - base])
        at = to
    return out


def window_sums(buf: np.ndarray, width: int) -> np.ndarray:
    """Hash of every ``width`` bytes, by their first position."""
    sums = prefix_sums(buf)
    n = max(0, len(buf) - width + 1)
    return mix((sums[width:width + n] - sums[:n]) * powers(_BACK, n)) if n else np.zeros(0, np.uint64)


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string or binary column and the bounds of its rows; null is empty."""
    kind = pa.large_binary()
    column = pc.fill_null(column.cast(kind), b"")
    n = len(column)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, np.int64)[column.offset:column.offset + n + 1]
    buf = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return buf[bounds[0]:bounds[-1]], bounds - bounds[0]


def slices(batches: Iterator[pa.RecordBatch], text: str = "text", limit: int = SLICE_BYTES, keep: str | None = None) -> Iterator[pa.RecordBatch]:
    """Cut batches so that the texts of a piece have about ``limit`` bytes; a longer text stands alone. Memory goes back at the end of a task.

    Of what earlier tasks of the worker have ``kept``, only ``keep`` stays.
    """
    if others := _kept.keys() - {keep}:
        for name in others:
            del _kept[name]
        give_back()
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch.column(text)), 0)
        ends = np.cumsum(lengths.to_numpy(zero_copy_only=False).astype(np.int64))
        at = 0
        while at < batch.num_rows:
            before = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, before + limit, side="right")))
            yield batch.slice(at, to - at)
            at = to
    give_back()


class Words:
    """The words of some texts: ``starts`` and ``ends`` in ``buf``; text k has words ``of[k]`` to ``of[k + 1]``."""

    def __init__(self, column: pa.Array, lower: bool = True, space: np.ndarray = IS_SPACE):
        buf, self.bounds = flat(column)
        self.buf = LOWER[buf] if lower else buf
        inside = ~space[buf]
        first = inside.copy()
        first[1:] &= ~inside[:-1]
        last = inside.copy()
        last[:-1] &= ~inside[1:]
        cut = self.bounds[1:-1]
        cut = cut[cut < len(buf)]
        first[cut] = inside[cut]
        cut = cut[cut > 0]
        last[cut - 1] = inside[cut - 1]
        self.starts = np.flatnonzero(first)
        self.ends = np.flatnonzero(last) + 1
        self.of = np.searchsorted(self.starts, self.bounds)

    def __len__(self) -> int:
        return len(self.starts)

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.of)

    @property
    def text_of(self) -> np.ndarray:
        """Which text each word belongs to."""
        return np.repeat(np.arange(len(self.of) - 1), self.counts)

    def hashes(self) -> np.ndarray:
        return span_hashes(self.buf, self.starts, self.ends)


def distinct_hashes(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """As ``np.unique`` with indexes, but any place of a hash may stand for it, so the faster unstable sort will do."""
    order = np.argsort(hashes)
    ordered = hashes[order]
    new = np.ones(len(hashes), bool)
    new[1:] = ordered[1:] != ordered[:-1]
    which = np.empty(len(hashes), np.int64)
    which[order] = np.cumsum(new) - 1
    return ordered[new], order[new], which


def span_bytes(buf: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The bytes of all spans in a row."""
    at = np.repeat(starts - (np.cumsum(lengths) - lengths), lengths)
    at += np.arange(len(at))
    return buf[at]


def distinct_spans(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first, which): one span for each different string, and the place in ``first`` of every span's string.

    Spans are grouped by hash and then compared with the one that stands for them, so a hash never decides.
    """
    _, first, which = np.unique(span_hashes(buf, starts, ends), return_index=True, return_inverse=True)
    lengths, like = ends - starts, first[which]
    if (lengths[like] == lengths).all() and (span_bytes(buf, starts, lengths) == span_bytes(buf, starts[like], lengths)).all():
        return first, which
    raw, numbers, first, which = buf.tobytes(), {}, [], np.empty(len(starts), np.int64)
    for k, (a, b) in enumerate(zip(starts.tolist(), ends.tolist())):
        which[k] = numbers.setdefault(raw[a:b], len(numbers))
        if which[k] == len(first):
            first.append(k)
    return np.array(first, np.int64), which


def ngram_hashes(hashes: np.ndarray, width: int) -> np.ndarray:
    """Hash of every ``width`` consecutive entries, by the first one, across text bounds."""
    n = max(0, len(hashes) - width + 1)
    total = np.zeros(n, np.uint64)
    for k in range(width):
        total += hashes[k:k + n] * np.uint64(pow(_STEP, 2 * k + 1, 1 << 64))
    return mix(total)


def shingles(words: Words, width: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the shingles of each text, repeats included, and the text of each.

    A text of fewer than ``width`` words has one shingle, all its words; a text without words has none.
    """
    hashes, counts = words.hashes(), words.counts
    grams = ngram_hashes(hashes, width)
    text_of = words.text_of
    place = np.arange(len(hashes))
    whole = place + width <= words.of[1:][text_of]
    values, owner = grams[whole[:len(grams)]], text_of[whole]
    short = np.flatnonzero((counts > 0) & (counts < width))
    if len(short):
        extra = np.array([
            int(mix(np.uint64(1 + len(part)) + ngram_hashes(part, len(part)))[0])
            for part in (hashes[words.of[k]:words.of[k + 1]] for k in short)
        ], np.uint64)
        values, owner = np.concatenate([values, extra]), np.concatenate([owner, short])
    return values, owner


def distinct_sets(values: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted by owner, then value; each value once per owner."""
    order = np.lexsort((values, owner))
    values, owner = values[order], owner[order]
    keep = np.ones(len(values), bool)
    keep[1:] = (values[1:] != values[:-1]) | (owner[1:] != owner[:-1])
    return values[keep], owner[keep]


def binary_rows(values: np.ndarray, counts: np.ndarray) -> pa.Array:
    """Consecutive runs of ``values`` as rows of bytes."""
    bounds = np.zeros(len(counts) + 1, np.int64)
    np.cumsum(counts * values.itemsize, out=bounds[1:])
    return pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(counts), [None, pa.py_buffer(bounds), pa.py_buffer(np.ascontiguousarray(values))]
    ).cast(pa.binary())


def list_rows(values: np.ndarray, counts: np.ndarray) -> pa.Array:
    """Consecutive runs of ``values`` as rows of lists."""
    bounds = np.zeros(len(counts) + 1, np.int32)
    np.cumsum(counts, out=bounds[1:])
    return pa.ListArray.from_arrays(pa.array(bounds), pa.array(values))
