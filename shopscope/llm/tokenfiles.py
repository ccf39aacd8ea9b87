"""Token ids in wavelet-matrix shard files (operator 1).

Documents are range-partitioned and sorted by id and encoded in order; every shard of about
``shard_tokens`` ids becomes one compressed block of bytes, a row (part, shard, tokens, bytes) of the
token files, which Spark writes and commits as Parquet. A shard's bytes alone answer everything about it:

* header, document bounds, the sorted distinct ids (the shard's alphabet);
* one bit-plane per bit of the alphabet's numbers, highest first. A plane holds that bit of every token, after the tokens were
  stably parted by the planes before it: a wavelet matrix. Planes are cut into blocks of 2 ** 15 bits, deflated each,
  with the number of ones before every block.

``token(i)`` reads one bit per plane, ``count(id, to)`` how often an id occurs before a place, ``find(id, k)`` the place of its
k-th occurrence; each touches a block or two per plane. ``ids()`` unpacks a whole shard plane by plane from the last to the first.

Encoding gives the tokenizer library's own ids. Texts are cut before single blanks (and line breaks) with a
character that surely is no white space (printing ASCII, Latin letters of two bytes) on one side and none of ASCII's white space on the other,
between such a line break and a letter, and between a letter and an ASCII sign. The byte-level rules always start a new piece there. Equal cuts of a
slice are encoded once, and their bytes are compared in full, so a hash never decides. Up to ``KNOWN_WORDS`` short words and their ids stay
known to a worker over its slices and tasks, about 50 bytes a word.

Null and empty texts have only the end id. Rows of one id are in order of their text; null ids come first. Empty tables give files without rows.
"""

from __future__ import annotations

import hashlib
import os
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from shopscope.llm.text import distinct_hashes, flat, give_back, kept, list_rows, slices, span_bytes, span_hashes
from shopscope.session import scratch_dir

END_ID = 2
SHARD_TOKENS = 1 << 19
SLICE = (1 << 20) - 1024
BLOCK_BITS = 1 << 15
KNOWN_WORDS = 1 << 19
MAGIC = b"WAVELET1"
FILE_SCHEMA = "part int, shard int, n_tokens long, bytes binary"


class Known:
    """Words met before and their ids: numbers of words by their hashes. Bytes are compared in full, so a hash never decides."""

    def __init__(self):
        self.clear()

    def clear(self) -> None:
        self.hashes, self.numbers = np.zeros(0, np.uint64), np.zeros(0, np.int32)
        self.starts = self.lengths = self.id_starts = self.counts = np.zeros(0, np.int32)
        self.buf, self.ids = np.zeros(0, np.uint8), np.zeros(0, np.uint32)

    def __len__(self) -> int:
        return len(self.hashes)

    def find(self, hashes: np.ndarray, buf: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """The number of every word, or -1."""
        if not len(self) or not len(hashes):
            return np.full(len(hashes), -1, np.int32)
        place = np.minimum(np.searchsorted(self.hashes, hashes), len(self) - 1)
        number = self.numbers[place]
        number[(self.hashes[place] != hashes) | (self.lengths[number] != lengths)] = -1
        met = np.flatnonzero(number >= 0)
        lengths, edges = lengths[met], np.cumsum(lengths[met])
        unlike = span_bytes(buf, starts[met], lengths) != span_bytes(self.buf, self.starts[number[met]], lengths)
        number[met[np.searchsorted(edges, np.flatnonzero(unlike), side="right")]] = -1
        return number

    def add(self, hashes: np.ndarray, buf: np.ndarray, starts: np.ndarray, lengths: np.ndarray, ids: np.ndarray, counts: np.ndarray) -> None:
        """Keep words in ascending order of their hashes; one whose hash another word has is left out."""
        place = np.searchsorted(self.hashes, hashes)
        new = np.ones(len(hashes), bool)
        if len(self):
            new = self.hashes[np.minimum(place, len(self) - 1)] != hashes
        place, lengths, counts, id_starts = place[new], lengths[new], counts[new], (np.cumsum(counts) - counts)[new]
        numbers = np.arange(len(self), len(self) + len(place), dtype=np.int32)
        self.hashes, self.numbers = np.insert(self.hashes, place, hashes[new]), np.insert(self.numbers, place, numbers)

        def behind(old: np.ndarray, more: np.ndarray) -> np.ndarray:
            return np.concatenate([old, more.astype(old.dtype)])

        self.starts, self.lengths = behind(self.starts, len(self.buf) + np.cumsum(lengths) - lengths), behind(self.lengths, lengths)
        self.id_starts, self.counts = behind(self.id_starts, len(self.ids) + np.cumsum(counts) - counts), behind(self.counts, counts)
        self.buf, self.ids = behind(self.buf, span_bytes(buf, starts[new], lengths)), behind(self.ids, span_bytes(ids, id_starts, counts))


class Encoder:
    """Encodes the texts of a slice, every distinct cut once."""

    def __init__(self, path: str, known: Known | None = None):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        # Cuts are distinct already; the library's own cache would only cost time.
        self.tokenizer.model._resize_cache(0)
        self.known = Known() if known is None else known
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        #: Bytes that an id stands for: a character each in the byte-level alphabet; -1 for added tokens.
        self.widths = np.zeros(max(vocabulary.values()) + 1, np.int64)
        added = self.tokenizer.get_added_tokens_decoder()
        for piece, k in vocabulary.items():
            self.widths[k] = len(piece.encode()) if k in added else len(piece)
        self.added = [t.content.encode() for t in added.values()]
        gap = np.zeros(256, bool)
        gap[[0x20, 0x0A]] = True
        solid = np.zeros(256, bool)
        solid[33:127] = True
        # Beyond ASCII there are other white spaces; one neighbour that surely is none is enough.
        ink = solid.copy()
        ink[128:] = True
        self.gap, self.solid, self.ink = gap, solid, ink
        self.letter = np.zeros(256, bool)
        self.letter[65:91] = self.letter[97:123] = True
        self.point = solid & ~self.letter
        self.point[48:58] = False
        #: The byte-level alphabet: printing Latin-1 characters stand for themselves, the other bytes for characters from 256 on.
        own = [*range(33, 127), *range(161, 173), *range(174, 256)]
        self.alphabet = np.arange(256, dtype="<u2")
        self.alphabet[sorted(set(range(256)) - set(own))] = np.arange(256, 512 - len(own))

    @staticmethod
    def marks(raw: bytes, table: np.ndarray) -> np.ndarray:
        """``table`` at every byte; the bytes' own translation is several times faster than an index."""
        return np.frombuffer(raw.translate(table.tobytes()), bool)

    def letters(self, raw: bytes) -> np.ndarray:
        """Which bytes belong to letters: ASCII ones, and Latin ones of two bytes (U+00C0 to U+023F without the signs of times and division)."""
        buf = np.frombuffer(raw, np.uint8)
        latin = (buf[:-1] >= 0xC3) & (buf[:-1] <= 0xC8) & ~((buf[:-1] == 0xC3) & ((buf[1:] == 0x97) | (buf[1:] == 0xB7)))
        out = self.marks(raw, self.letter).copy()
        out[:-1] |= latin
        out[1:] |= latin
        return out

    def plain(self, text: bytes) -> list[int]:
        return self.tokenizer.encode(text.decode(), add_special_tokens=False).ids

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and the number of ids of each."""
        buf, bounds = flat(column)
        n = len(bounds) - 1
        if not len(buf):
            return np.zeros(0, np.uint32), np.zeros(n, np.int64)
        raw = buf.tobytes()
        cut = np.zeros(len(buf) + 1, bool)
        letters = self.letters(raw)
        sure, ink, gap, point = self.marks(raw, self.solid) | letters, *(self.marks(raw, t) for t in (self.ink, self.gap, self.point))
        cut[1:-2] = gap[1:-1] & ((sure[:-2] & ink[2:]) | (ink[:-2] & sure[2:]))
        cut[1:-1] |= (cut[:-2] & (buf[:-1] == 0x0A) & letters[1:]) | (letters[:-1] & point[1:])
        cut[bounds] = True
        edges = np.flatnonzero(cut)
        starts, ends = edges[:-1], edges[1:]
        # Texts with an added token's name in them are encoded whole: it may span a cut.
        odd = [k for k in range(n) if any(a in raw[bounds[k]:bounds[k + 1]] for a in self.added)] if any(a in raw for a in self.added) else []
        hashes, first, which = distinct_hashes(span_hashes(buf, starts, ends))
        lengths = ends - starts
        # Every cut must equal the one that stands for it, byte by byte.
        kind = np.int32 if len(buf) < 1 << 31 else np.int64
        like = np.repeat((starts[first][which] - starts).astype(kind), lengths)
        like += np.arange(len(buf), dtype=kind)
        if (lengths[first][which] != lengths).any() or (buf.take(like, mode="clip") != buf).any():
            odd = list(range(n))
        ids_of, counts_of = self._distinct(raw, letters, sure, starts[first], ends[first], hashes)
        at = np.concatenate([[0], np.cumsum(counts_of)])
        counts = counts_of[which]
        where = np.repeat(at[which] - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())
        ids = ids_of[where]
        of_text = np.concatenate([[0], np.cumsum(counts)])[np.searchsorted(starts, bounds)]
        totals = np.diff(of_text)
        if odd:
            parts = np.split(ids, of_text[1:-1])
            for k in odd:
                parts[k] = np.array(self.plain(raw[bounds[k]:bounds[k + 1]]), np.uint32)
                totals[k] = len(parts[k])
            ids = np.concatenate(parts)
        return ids, totals

    def _distinct(
        self, raw: bytes, letters: np.ndarray, sure: np.ndarray, starts: np.ndarray, ends: np.ndarray, hashes: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray]:
        """Ids of distinct cuts in ascending order of their hashes, and the number of ids of each.

        Letters, with a blank before them or none, are one piece before merging, so they go straight to the library's merges, unless met in a
        slice before. Other cuts that begin with a
        blank and a character that is no white space can follow any that ends without white space, and are encoded many to a text; the rest one by one.
        """
        buf = np.frombuffer(raw, np.uint8)
        lengths = ends - starts
        blank = buf[starts] == 0x20
        so_far = np.concatenate([[0], np.cumsum(letters, dtype=np.int32 if len(buf) < 1 << 31 else np.int64)])
        words = (lengths > blank) & (so_far[ends] - so_far[starts] == lengths - blank)
        joins = blank & (lengths > 1) & sure[np.minimum(starts + 1, len(buf) - 1)] & self.ink[buf[ends - 1]] & ~words
        counts = np.zeros(len(starts), np.int64)
        parts: list[tuple[np.ndarray, np.ndarray]] = []

        def add(which: np.ndarray, found: list) -> None:
            parts.append((which, np.concatenate(found) if found else np.zeros(0, np.uint32)))

        which = np.flatnonzero(words)
        known = self.known
        number = known.find(hashes[which], buf, starts[which], lengths[which])
        met, number = which[number >= 0], number[number >= 0]
        counts[met] = known.counts[number]
        add(met, [span_bytes(known.ids, known.id_starts[number], known.counts[number])])

        counted = np.zeros(len(starts), bool)
        counted[met] = True
        which = which[~counted[which]]
        merge, got, sizes = self.tokenizer.model.tokenize, [], []
        tape = self.alphabet[span_bytes(buf, starts[which], lengths[which])].tobytes().decode("utf-16-le")
        edges = np.concatenate([[0], np.cumsum(lengths[which])]).tolist()
        for a, b in zip(edges[:-1], edges[1:]):
            found = merge(tape[a:b])
            sizes.append(len(found))
            got += [t.id for t in found]
        ids = np.array(got, np.uint32)
        counts[which] = sizes
        add(which, [ids])
        if len(known) > KNOWN_WORDS:
            known.clear()
        short = lengths[which] < 32
        kept, n = which[short], counts[which]
        known.add(hashes[kept], buf, starts[kept], lengths[kept], ids[np.repeat(short, n)], n[short])

        which = np.flatnonzero(joins)
        group = np.cumsum(lengths[which]) // 1024
        edges = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1], [True]])).tolist() if len(which) else []
        spans = list(zip(starts[which].tolist(), ends[which].tolist()))
        runs = list(zip(edges[:-1], edges[1:]))
        found = []
        for at in range(0, len(runs), 64):
            some = runs[at:at + 64]
            texts = [b"".join(raw[x:y] for x, y in spans[a:b]).decode() for a, b in some]
            for encoding, (a, b) in zip(self.tokenizer.encode_batch_fast(texts, add_special_tokens=False), some):
                ids = np.array(encoding.ids, np.uint32)
                edge = np.searchsorted(np.cumsum(self.widths[ids]), np.cumsum(lengths[which[a:b]]), side="right")
                counts[which[a:b]] = np.diff(np.concatenate([[0], edge]))
                found.append(ids)
        add(which, found)

        which = np.flatnonzero(~words & ~joins)
        found = []
        for at in range(0, len(which), 512):
            some = which[at:at + 512]
            encodings = self.tokenizer.encode_batch_fast([raw[starts[k]:ends[k]].decode() for k in some], add_special_tokens=False)
            for k, encoding in zip(some, encodings):
                counts[k] = len(encoding.ids)
                found.append(np.array(encoding.ids, np.uint32))
        add(which, found)

        ids = np.empty(counts.sum(), np.uint32)
        place = np.cumsum(counts) - counts
        for which, values in parts:
            n = counts[which]
            ids[np.repeat(place[which] - (np.cumsum(n) - n), n) + np.arange(n.sum())] = values
        return ids, counts


def pack(ids: np.ndarray, doc_ids: list[int | None], counts: np.ndarray) -> bytes:
    """The bytes of a shard: the tokens of some documents."""
    n = len(ids)
    top = int(ids.max()) + 1 if n else 1
    present = np.bincount(ids, minlength=top) > 0 if top < 1 << 22 else None
    alphabet = (np.flatnonzero(present) if present is not None else np.unique(ids)).astype(np.uint32)
    if present is not None:
        number = np.zeros(top, np.uint32)
        number[alphabet] = np.arange(len(alphabet), dtype=np.uint32)
        codes = number[ids]
    else:
        codes = np.searchsorted(alphabet, ids).astype(np.uint32)
    depth = max(1, int(len(alphabet) - 1).bit_length())
    codes = codes.astype(np.uint16 if depth <= 16 else np.uint32)
    planes, ones, zeros = [], [], []
    for level in range(depth):
        bit = (codes & codes.dtype.type(1 << (depth - 1 - level))) != 0
        plane = np.packbits(bit, bitorder="little")
        packed = plane.tobytes()
        planes.append([zlib.compress(packed[k:k + BLOCK_BITS // 8], 1) for k in range(0, len(packed), BLOCK_BITS // 8)])
        in_block = [int(np.bitwise_count(plane[k:k + BLOCK_BITS // 8]).sum()) for k in range(0, len(plane), BLOCK_BITS // 8)]
        totals = np.concatenate([[0], np.cumsum(in_block)]).astype(np.int64)
        ones.append(totals)
        zeros.append(n - int(totals[-1]))
        codes = np.concatenate([np.compress(~bit, codes), np.compress(bit, codes)])
    known = np.array([d is not None for d in doc_ids], bool)
    docs = np.array([d or 0 for d in doc_ids], np.int64)
    lengths = np.array([len(b) for p in planes for b in p], np.int64)
    head = struct.pack("<qqqq", n, len(doc_ids), len(alphabet), depth)
    side = zlib.compress(b"".join([docs.tobytes(), known.tobytes(), counts.astype(np.int64).tobytes(), alphabet.tobytes()]), 1)
    index = np.concatenate([np.array(zeros, np.int64), *ones, lengths]).astype(np.int64).tobytes()
    return b"".join([MAGIC, head, struct.pack("<q", len(side)), side, index, *(b for p in planes for b in p)])


class Shard:
    """A shard read back from its bytes."""

    def __init__(self, data: bytes):
        if data[:8] != MAGIC:
            raise ValueError("not a token shard")
        self.n, docs, letters, self.depth = struct.unpack("<qqqq", data[8:40])
        (size,) = struct.unpack("<q", data[40:48])
        side = zlib.decompress(data[48:48 + size])
        ids = np.frombuffer(side, np.int64, docs)
        known = np.frombuffer(side, bool, docs, 8 * docs)
        self.doc_ids = [k if ok else None for k, ok in zip(ids.tolist(), known.tolist())]
        self.counts = np.frombuffer(side, np.int64, docs, 9 * docs)
        self.alphabet = np.frombuffer(side, np.uint32, letters, 17 * docs)
        blocks = -(-self.n // BLOCK_BITS)
        at = 48 + size
        self.zeros = np.frombuffer(data, np.int64, self.depth, at)
        at += 8 * self.depth
        self.ones = np.frombuffer(data, np.int64, self.depth * (blocks + 1), at).reshape(self.depth, blocks + 1)
        at += 8 * self.ones.size
        lengths = np.frombuffer(data, np.int64, self.depth * blocks, at).reshape(self.depth, blocks)
        at += 8 * lengths.size
        self.places = (at + np.concatenate([[0], np.cumsum(lengths.ravel())])).astype(np.int64)
        self.blocks, self.data = blocks, data
        self._open: dict[tuple[int, int], np.ndarray] = {}

    def _block(self, level: int, k: int) -> np.ndarray:
        if (level, k) not in self._open:
            at = level * self.blocks + k
            raw = zlib.decompress(self.data[self.places[at]:self.places[at + 1]])
            size = min(BLOCK_BITS, self.n - k * BLOCK_BITS)
            self._open[level, k] = np.unpackbits(np.frombuffer(raw, np.uint8), count=size, bitorder="little")
        return self._open[level, k]

    def _rank(self, level: int, to: int) -> int:
        """Ones of a plane before a place."""
        k, rest = divmod(to, BLOCK_BITS)
        return int(self.ones[level, k]) + (int(self._block(level, k)[:rest].sum()) if rest else 0)

    def _select(self, level: int, bit: int, k: int) -> int:
        """Place of the k-th (from 0) one or zero of a plane."""
        before = self.ones[level] if bit else np.minimum(np.arange(self.blocks + 1) * BLOCK_BITS, self.n) - self.ones[level]
        block = int(np.searchsorted(before, k, side="right")) - 1
        return block * BLOCK_BITS + int(np.flatnonzero(self._block(level, block) == bit)[k - before[block]])

    def token(self, i: int) -> int:
        """The id at a place."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        code = 0
        for level in range(self.depth):
            bit = int(self._block(level, i // BLOCK_BITS)[i % BLOCK_BITS])
            ones = self._rank(level, i)
            code = code * 2 + bit
            i = int(self.zeros[level]) + ones if bit else i - ones
        return int(self.alphabet[code])

    def _range(self, token: int, to: int) -> tuple[int, int, int] | None:
        code = int(np.searchsorted(self.alphabet, token))
        if code == len(self.alphabet) or self.alphabet[code] != token:
            return None
        a, b = 0, to
        for level in range(self.depth):
            lo, hi = self._rank(level, a), self._rank(level, b)
            if code >> (self.depth - 1 - level) & 1:
                a, b = int(self.zeros[level]) + lo, int(self.zeros[level]) + hi
            else:
                a, b = a - lo, b - hi
        return code, a, b

    def count(self, token: int, to: int | None = None) -> int:
        """Occurrences of an id before a place."""
        found = self._range(token, self.n if to is None else to)
        return found[2] - found[1] if found else 0

    def find(self, token: int, k: int) -> int:
        """Place of the k-th (from 0) occurrence of an id."""
        found = self._range(token, self.n)
        if not found or not 0 <= k < found[2] - found[1]:
            raise IndexError((token, k))
        code, at, _ = found
        at += k
        for level in reversed(range(self.depth)):
            if code >> (self.depth - 1 - level) & 1:
                at = self._select(level, 1, at - int(self.zeros[level]))
            else:
                at = self._select(level, 0, at)
        return at

    def ids(self) -> np.ndarray:
        """All ids in order: the parting of each plane is undone, the last one first."""
        kind = np.uint16 if self.depth <= 16 else np.uint32
        codes = np.zeros(self.n, kind)
        for level in reversed(range(self.depth)):
            raw = b"".join(zlib.decompress(self.data[a:b]) for a, b in zip(*(self.places[level * self.blocks + s:][:self.blocks] for s in (0, 1))))
            bit = np.unpackbits(np.frombuffer(raw, np.uint8), count=self.n, bitorder="little").view(bool)
            zeros = int(self.zeros[level])
            above = np.empty_like(codes)
            # Places, not masks: numpy writes to them several times faster.
            above[np.flatnonzero(~bit)] = codes[:zeros]
            above[np.flatnonzero(bit)] = codes[zeros:] | kind(1 << (self.depth - 1 - level))
            codes = above
        return self.alphabet[codes] if self.n else np.zeros(0, np.uint32)


def _writer(vocabulary: str, end_id: int, shard_tokens: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Known words go on to the worker's next task, under a name that stands for what the vocabulary holds.
        with open(vocabulary, "rb") as file:
            name = f"words of {hashlib.sha256(file.read()).hexdigest()}"
        encoder = Encoder(vocabulary, kept(name, Known))
        part = TaskContext.get().partitionId()
        held_ids, held_docs, held_counts, size, shard = [], [], [], 0, 0

        def flush():
            nonlocal held_ids, held_docs, held_counts, size, shard
            data = pack(np.concatenate(held_ids), held_docs, np.concatenate(held_counts))
            row = pa.record_batch([pa.array([part], pa.int32()), pa.array([shard], pa.int32()), pa.array([size], pa.int64()), pa.array([data], pa.binary())],
                                  ["part", "shard", "n_tokens", "bytes"])
            held_ids, held_docs, held_counts, size, shard = [], [], [], 0, shard + 1
            return row

        for piece in slices(batches, limit=SLICE, keep=name):
            ids, counts = encoder.encode(piece.column("text"))
            # The end id goes behind each text.
            ids = np.insert(ids, np.cumsum(counts), end_id) if len(counts) else ids
            counts = counts + 1
            docs = piece.column("doc_id").to_pylist()
            ends = np.cumsum(counts)
            at = 0
            while at < len(counts):
                before = int(ends[at - 1]) if at else 0
                to = max(at + 1, int(np.searchsorted(ends, before + shard_tokens - size, side="right")))
                held_ids.append(ids[before:ends[to - 1]].astype(np.uint32))
                held_docs += docs[at:to]
                held_counts.append(counts[at:to])
                size += int(ends[to - 1]) - before
                at = to
                if size >= shard_tokens or at < len(counts):
                    yield flush()
        if size:
            yield flush()
        del encoder
        give_back()

    return run


def write(docs: DataFrame, path: str, vocabulary: str, end_id: int = END_ID, shard_tokens: int = SHARD_TOKENS) -> None:
    """Write the token files of ``docs`` in ascending id order."""
    rows = docs.select("doc_id", "text")
    # A partition per 32 MB of text or so, as the scan has it; the range exchange keeps ids in order.
    parts = max(1, rows.rdd.getNumPartitions())
    ordered = rows.repartitionByRange(parts, "doc_id").sortWithinPartitions("doc_id", "text")
    ordered.mapInArrow(_writer(vocabulary, end_id, shard_tokens), FILE_SCHEMA).write.parquet(path)


def read_documents(spark: SparkSession, path: str, ids: bool = False) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32, part, shard) of every document of the token files, and with ``ids`` its ids.

    ``start`` counts the ids of all documents before it, the crc32 is over the ids as little-endian 32-bit numbers.
    """
    files = spark.read.schema(FILE_SCHEMA).parquet(path)
    per_part = files.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    # One row per written partition: the only thing that is ordered as a whole.
    before = per_part.select(F.col("part").alias("of_part"), F.coalesce(F.sum("n").over(
        W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("part_start"))
    within = files.select("part", "shard", "n_tokens").select(F.col("part").alias("p"), F.col("shard").alias("s"), F.coalesce(F.sum("n_tokens").over(
        W.partitionBy("part").orderBy("shard").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("shard_start"))
    bases = within.join(before, F.col("p") == F.col("of_part")).select("p", "s", (F.col("part_start") + F.col("shard_start")).alias("base"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, shard, data in zip(*(batch.column(c).to_pylist() for c in ("part", "shard", "bytes"))):
                tokens = Shard(data)
                values = tokens.ids()
                raw = values.astype("<u4").tobytes()
                ends = np.cumsum(tokens.counts)
                crcs = [zlib.crc32(memoryview(raw)[4 * (e - n):4 * e]) for e, n in zip(ends.tolist(), tokens.counts.tolist())]
                n = len(crcs)
                columns = [pa.array(tokens.doc_ids, pa.int64()), pa.array(ends - tokens.counts), pa.array(tokens.counts), pa.array(crcs, pa.int64()),
                           pa.array(np.full(n, part, np.int32)), pa.array(np.full(n, shard, np.int32))]
                names = ["doc_id", "offset", "n_tokens", "ids_crc32", "part", "shard"]
                if ids:
                    columns.append(list_rows(values.astype(np.int64), tokens.counts))
                    names.append("ids")
                yield pa.record_batch(columns, names)

    schema = "doc_id long, offset long, n_tokens long, ids_crc32 long, part int, shard int" + (", ids array<long>" if ids else "")
    decoded = files.select("part", "shard", "bytes").mapInArrow(run, schema)
    placed = decoded.join(bases, (F.col("part") == F.col("p")) & (F.col("shard") == F.col("s")))
    return placed.select("doc_id", (F.col("base") + F.col("offset")).alias("start"), "n_tokens", "ids_crc32", "part", "shard", *(["ids"] if ids else []))


def encode(docs: DataFrame, vocabulary: str, path: str | None = None, **settings) -> DataFrame:
    """Write the token files, to a scratch folder unless ``path`` says where, and read their documents back. Runs jobs."""
    path = path or f"{scratch_dir(docs.sparkSession)}/tokens"
    write(docs, path, vocabulary, **settings)
    return read_documents(docs.sparkSession, path)
