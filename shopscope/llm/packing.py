"""Best-fit packing of documents into sequences of tokens (operator 12).

Texts become ids of a word-piece tokenizer, an end id follows each, and only what is longer than a sequence is cut. The
pieces are packed by best fit in falling order of length, bulk-synchronously:

1. *Range sort.* The pieces of one length are one class, numbered by the task that cut them and their turn in it. Gaps
   (what is left of an open sequence) of one size are a class too, numbered by sequence.
2. *Successor sweep.* A superstep takes the longest class of pieces that is left and sweeps the classes of gaps upwards from
   its length: the least gap that fits is used up first, each gap taking as many pieces of the length as it holds.
3. *Conflicts by rank.* Piece number r of a class belongs to the gap in whose run of numbers r falls, so no two pieces claim one
   place. Pieces beyond the last gap open sequences.
4. *Update.* Gaps that took pieces move to the class of what they have left; repeat with the next length.

Pieces of a length are alike and so are gaps of a size. A superstep therefore needs their numbers only: a table of at most
``capacity`` rows, summed by Spark, whatever the corpus. The supersteps run over this table and leave a plan of runs (length, first number, pieces
in a gap, first sequence, offset); every piece then finds its run by a search for its predecessor, in the tasks that hold the pieces. A superstep cuts at most three
runs of gaps, and a sequence holds at most sqrt(2 * capacity) different lengths, so a plan has at most 3 * capacity * sqrt(2 * capacity)
runs (0.4 million for 2048) and is sent to every task. The result is that of best fit decreasing one piece at a time.

Null and empty texts have the end id alone; repeated rows and null ids are documents of their own; ties (pieces of one length) are taken in the
order of their numbers. A text of any length is cut into pieces within its task. An empty table gives no rows. Columns beside doc_id and text are not read.
The pieces are written once to the shared folder, with their numbers, so a lost task cannot renumber them.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from shopscope.llm.text import LOWER, Words, distinct_spans, slices
from shopscope.session import stored

CAPACITY = 2048
END_ID = 0
KNOWN_WORDS = 1 << 18
SLICE = 2 << 20
LETTER, DIGIT, SIGN, ODD = range(1, 5)


class WordPieces:
    """Ids of texts for a lower-casing tokenizer that drops white space and splits letters, single digits and signs.

    Neither normalisation nor a piece spans white space in such a vocabulary, so words are encoded apart. Words of printing ASCII (without apostrophes, which
    may begin a contraction, and names of added tokens) and two-byte Latin letters are cut further, into runs of letters, digits and runs of signs, as the
    vocabulary's own pattern does. Every different string is encoded once by the library.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        self.clear()
        kind = np.full(256, ODD, np.uint8)
        kind[33:127], kind[48:58] = SIGN, DIGIT
        kind[65:91] = kind[97:123] = LETTER
        kind[0x27] = ODD
        self.kind = kind
        #: The byte-level alphabet: printing Latin-1 characters stand for themselves, the other bytes for characters from 256 on.
        own = [*range(33, 127), *range(161, 173), *range(174, 256)]
        self.alphabet = np.arange(256, dtype="<u2")
        self.alphabet[sorted(set(range(256)) - set(own))] = np.arange(256, 512 - len(own))
        # Strings are distinct already; the library's own cache would only cost time.
        self.tokenizer.model._resize_cache(0)

    def clear(self) -> None:
        self.known: dict[bytes, int] = {}
        self.start, self.size, self.tape = (np.zeros(0, t) for t in (np.int64, np.int64, np.uint32))

    def kinds(self, buf: np.ndarray) -> np.ndarray:
        """What each byte is part of; white space does not matter."""
        kind = self.kind[buf]
        if len(buf) > 1:
            # U+00C0 to U+023F are letters but for the signs of times and division; the dotted capital I becomes two characters.
            lead, tail = buf[:-1], buf[1:]
            latin = (lead >= 0xC3) & (lead <= 0xC8) & ~((lead == 0xC3) & ((tail == 0x97) | (tail == 0xB7))) & ~((lead == 0xC4) & (tail == 0xB0))
            at = np.flatnonzero(latin)
            kind[at] = kind[at + 1] = LETTER
            # Where an added token's name may begin.
            kind[:-1][(lead == 0x3C) & (tail == 0x7C)] = ODD
        return kind

    def pieces(self, words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Bytes, starts and ends of the strings to encode, in order, and which bytes belong to letters of words that were cut."""
        buf, starts, ends = words.buf, words.starts, words.ends
        kind = self.kinds(buf)
        strange = np.concatenate([[0], np.cumsum(kind == ODD, dtype=np.int64)])
        plain = strange[ends] == strange[starts]
        inside = np.zeros(len(buf) + 1, np.int8)
        inside[starts[plain]] += 1
        inside[ends[plain]] -= 1
        inside = np.cumsum(inside[:-1], dtype=np.int8).view(bool)
        cut = np.zeros(len(buf), bool)
        cut[1:] = inside[1:] & ((kind[1:] != kind[:-1]) | (kind[1:] == DIGIT))
        cut[starts] = True
        from_ = np.flatnonzero(cut)
        to = np.append(from_[1:], len(buf))
        word = np.searchsorted(starts, from_, side="right") - 1
        return np.where(inside, LOWER[buf], buf), from_, np.minimum(to, ends[word]), inside & (kind == LETTER)

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and the number of ids of each."""
        words = Words(column, lower=False)
        if not len(words):
            return np.zeros(0, np.uint32), np.zeros(len(words.of) - 1, np.int64)
        buf, starts, ends, letters = self.pieces(words)
        first, which = distinct_spans(buf, starts, ends)
        raw = buf.tobytes()
        strings = [raw[a:b] for a, b in zip(starts[first].tolist(), ends[first].tolist())]
        number = self.numbers(strings, letters[starts[first]])[which]
        size = self.size[number]
        place = np.repeat(self.start[number] - (np.cumsum(size) - size), size)
        place += np.arange(len(place))
        ids = self.tape[place]
        before = np.concatenate([[0], np.cumsum(size)])
        edge = before[np.searchsorted(starts, words.bounds)]
        if len(self.known) > KNOWN_WORDS:
            self.clear()
        return ids, np.diff(edge)

    def numbers(self, strings: list[bytes], letters: np.ndarray) -> np.ndarray:
        """The place of each string in the tables of what is known; ``letters`` tells which are letters only."""
        known = self.known
        new = [k for k, w in enumerate(strings) if w not in known]
        plain = letters[new]
        words = [strings[k] for k, ok in zip(new, plain) if ok]
        others = [strings[k] for k, ok in zip(new, plain) if not ok]
        found: list[list[int]] = []
        if words:
            # A run of letters is one piece before merging, so it goes straight to the library's merges, in the byte-level alphabet.
            lower = b" ".join(words).decode().lower().encode()
            merge = self.tokenizer.model.tokenize
            tape = self.alphabet[np.frombuffer(lower, np.uint8)].tobytes().decode("utf-16-le")
            found += [[t.id for t in merge(w)] for w in tape.split(chr(self.alphabet[0x20]))]
        for at in range(0, len(others), 4096):
            found += [e.ids for e in self.tokenizer.encode_batch_fast([w.decode() for w in others[at:at + 4096]], add_special_tokens=False)]
        known.update(zip(words + others, range(len(known), len(known) + len(found))))
        size = np.array([len(ids) for ids in found], np.int64)
        self.start = np.concatenate([self.start, len(self.tape) + np.cumsum(size) - size])
        self.size = np.concatenate([self.size, size])
        self.tape = np.concatenate([self.tape, np.fromiter((i for ids in found for i in ids), np.uint32, int(size.sum()))])
        return np.array([known[w] for w in strings], np.int64)


PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, part int, nth long"


def _cut(vocabulary: str, capacity: int, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part = WordPieces(vocabulary), TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, np.int64)
        for rows in slices(batches, limit=SLICE):
            ids, counts = encoder.encode(rows.column("text"))
            raw = memoryview(np.insert(ids, np.cumsum(counts), end_id).astype("<u4").tobytes())
            counts = counts + 1
            pieces = -(-counts // capacity)
            of = np.repeat(np.arange(len(counts)), pieces)
            number = np.arange(len(of)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            start = number * capacity
            length = np.minimum(counts[of] - start, capacity)
            at = (np.cumsum(counts) - counts)[of] + start
            crcs = [zlib.crc32(raw[4 * a:4 * b]) for a, b in zip(at.tolist(), (at + length).tolist())]
            # The turn of each piece among those of its length in this task.
            order = np.argsort(length, kind="stable")
            tally = np.bincount(length, minlength=capacity + 1)
            nth = np.empty(len(of), np.int64)
            nth[order] = np.arange(len(of)) - np.repeat(np.cumsum(tally) - tally, tally) + np.repeat(seen, tally)
            seen += tally
            yield pa.record_batch(
                [rows.column("doc_id").take(pa.array(of)), pa.array(number.astype(np.int32)), pa.array(start), pa.array(length), pa.array(crcs, pa.int64()),
                 pa.array(np.full(len(of), part, np.int32)), pa.array(nth)],
                ["doc_id", "piece", "start", "length", "ids_crc32", "part", "nth"])

    return run


def best_fit(tally: dict[int, int], capacity: int = CAPACITY) -> np.ndarray:
    """The plan for so many pieces of each length: rows (length, first number, pieces in a gap, first sequence, offset).

    In order of length and number. A row covers the numbers up to the next row of its length, and consecutive sequences.
    """
    runs: list[tuple[int, int, int, int, int]] = []
    gaps: list[list[tuple[int, int]]] = [[] for _ in range(capacity + 1)]  # by size: (first sequence, how many)
    opened = 0
    for length in sorted((k for k, n in tally.items() if n), reverse=True):
        done, left = 0, tally[length]

        def fill(size: int, first: int, count: int) -> int:
            """Put pieces into gaps of a size; returns how many of the gaps stay as they are."""
            nonlocal done, left
            each = size // length
            full = min(count, left // each)
            rest = left - full * each if full < count else 0
            for gap, many, pieces in ((first, full, each), (first + full, min(rest, 1), rest)):
                if many:
                    runs.append((length, done, pieces, gap, capacity - size))
                    gaps[size - pieces * length].append((gap, many))
                    done += many * pieces
                    left -= many * pieces
            return count - full - min(rest, 1)

        for size in range(length, capacity + 1):
            while left and gaps[size]:
                first, count = gaps[size].pop()
                stay = fill(size, first, count)
                if stay:
                    gaps[size].append((first + count - stay, stay))
            if not left:
                break
        if left:
            count = -(-left // (capacity // length))
            fill(capacity, opened, count)
            opened += count
    return np.array(sorted(runs), np.int64).reshape(-1, 5)


def _place(plan):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        length_of, first, each, sequence, offset = plan.value.T
        # Numbers stay below 2 ** 48, lengths below 2 ** 15.
        keys = (length_of << 48) + first
        for batch in batches:
            length, rank = (batch.column(c).to_numpy() for c in ("length", "rank"))
            at = np.searchsorted(keys, (length << 48) + rank, side="right") - 1
            turn = rank - first[at]
            places = [pa.array(sequence[at] + turn // each[at]), pa.array(offset[at] + turn % each[at] * length)]
            kept = ["doc_id", "piece", "start", "length", "ids_crc32"]
            yield pa.record_batch([*(batch.column(c) for c in kept), *places], [*kept, "sequence_id", "offset"])

    return run


def pack(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset) per piece of every document. Runs jobs."""
    if not 0 < capacity < 1 << 15:
        raise ValueError("capacity must be from 1 to 32767")
    spark = docs.sparkSession
    pieces = stored(docs.select("doc_id", "text").mapInArrow(_cut(vocabulary, capacity, end_id), PIECES), "pieces")
    tally = pieces.groupBy("length", "part").agg(F.count(F.lit(1)).alias("n"))
    # One row per length: at most ``capacity`` rows reach the driver.
    totals = {r.length: r.n for r in tally.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    plan = spark.sparkContext.broadcast(best_fit(totals, capacity))
    earlier = W.partitionBy("length").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    before = tally.select("length", "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    ranked = pieces.join(before, ["length", "part"]).withColumn("rank", F.col("nth") + F.col("before"))
    return ranked.mapInArrow(_place(plan), "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
