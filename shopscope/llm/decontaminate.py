"""Benchmark decontamination by canonical templates (operator 6).

Tokens are runs of letters and digits (any byte from 0x80 on counts as a letter, but for typographic quotes, dashes and blanks; a point or comma between digits
belongs to the number). Numbers, units after a number, and names (a capital inside a sentence, not followed by another) become
typed placeholders, other tokens their lower-cased form. As case and the signs around a word may change in a copy, texts are also compared
in two more forms, and an item counts if any form has it: by words without names, whatever their case, and with a run of names as one
name, where a word after a bracket, a quote or a list sign is no name. Every five template tokens make a window; windows are hashed,
and the windows of a document meet those of the benchmark in a hash join. Windows with fewer than two
plain tokens say nothing and do not count, unless an item has no others.

For each item that a document meets, a window pair has an alignment (document place minus
item place), and alignments in a stretch of half an item's length are judged together, so only windows that lie together count. Every stretch that holds
enough windows is judged along each of its alignments: an item token stands for one document token, by the nearest alignment that has it. A document holds an item if at least
``share`` of the item's distinct windows occur in one such stretch and the placeholders agree along one alignment: every value that the item has in a slot must
stand for one value of the same type in the document (2 and 5 may become 7 and 9, but both 2s must become 7). That catches
re-parameterised questions and keeps apart texts that only share a form.

The benchmark's window table is split into blocks of at most ``block_windows`` windows; each block is sent to all tasks
(its size is bounded by that) and the documents are read once per block. No shuffle; each row is a
(document, item) pair that the task confirmed. Nulls and empty texts hold nothing; items without tokens are held by
nothing; items of fewer than five tokens are one window. Repeated document rows give repeated results.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopscope.llm.text import LOWER, flat, hash_bytes, mix, ngram_hashes, slices, span_hashes

WIDTH = 5
SHARE = 0.8
AGREE = 0.8
PLAIN = 2
BLOCK_WINDOWS = 1 << 20

UNITS = "mm cm m km in ft mi mg g kg lb oz t ml l gal s sec min h hr hours minutes seconds days weeks months years w kw kwh j kj n pa v a hz khz mhz ghz b kb mb gb tb usd eur dollars euros cents percent degrees miles meters metres grams litres liters".split()

_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_TOKEN = _DIGIT.copy()
_TOKEN[65:91] = _TOKEN[97:123] = _TOKEN[128:] = True
_MARK = np.zeros(256, bool)
_MARK[[ord(c) for c in ".,"]] = True
_STOP = np.zeros(256, bool)
_STOP[[ord(c) for c in ".!?:;\n\r|"]] = True
#: Signs that open a quotation, a bracket or a list entry.
_OPEN = _STOP.copy()
_OPEN[[ord(c) for c in "()[]{}<>\"*#_=/"]] = True

#: As the text has them; names as plain words; a run of names as one name.
FORMS = CASED, PLAINER, FOLDED = range(3)

NUMBER, UNIT, NAME = (np.uint64(hash_bytes(x)) for x in (b"\x00number", b"\x00unit", b"\x00name"))
_UNIT_HASHES = np.array(sorted(hash_bytes(u.encode()) for u in UNITS), np.uint64)


def _signs(buf: np.ndarray) -> np.ndarray:
    """Bytes of the signs U+2000 to U+203F (quotes, dashes, blanks), of angle quotes and of the hard blank."""
    out = np.zeros(len(buf), bool)
    three = np.flatnonzero((buf[:-2] == 0xE2) & (buf[1:-1] == 0x80))
    out[three] = out[three + 1] = out[three + 2] = True
    two = np.flatnonzero((buf[:-1] == 0xC2) & np.isin(buf[1:], [0xA0, 0xAB, 0xBB]))
    out[two] = out[two + 1] = True
    return out


class Template:
    """Tokens of some texts: canonical ``codes``, own hashes ``values``, ``kinds`` (0 plain, 1 number, 2 unit, 3 name), text k in ``of[k]`` to ``of[k + 1]``."""

    def __init__(self, column: pa.Array, form: int = CASED):
        buf, bounds = flat(column)
        inside = _TOKEN[buf] & ~_signs(buf)
        digit = _DIGIT[buf]
        inner = np.zeros(len(buf), bool)
        inner[1:-1] = _MARK[buf[1:-1]] & digit[:-2] & digit[2:]
        inside |= inner
        edge = np.zeros(len(buf) + 1, bool)
        edge[bounds] = True
        first = inside.copy()
        first[1:] &= ~inside[:-1] | edge[1:-1]
        last = inside.copy()
        last[:-1] &= ~inside[1:] | edge[1:-1]
        self.starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
        self.of = np.searchsorted(self.starts, bounds)
        self.values = span_hashes(LOWER[buf], self.starts, ends)
        head = buf[self.starts]
        number = digit[self.starts]
        fresh = np.zeros(len(self.starts), bool)
        fresh[self.of[:-1][self.of[:-1] < len(fresh)]] = True
        stops = np.concatenate([[0], np.cumsum((_OPEN if form == FOLDED else _STOP)[buf], dtype=np.int32)])
        fresh[1:] |= stops[self.starts[1:]] > stops[ends[:-1]]
        after = np.zeros(len(buf) + 1, np.uint8)
        after[:len(buf)] = buf
        second = after[self.starts + 1]
        capital = ((head >= 65) & (head <= 90)) | ((head == 0xC3) & (second >= 0x80) & (second <= 0x9E))
        # A word in capitals throughout is emphasis, not a name.
        name = capital & ~fresh & ~((second >= 65) & (second <= 90)) & (form != PLAINER)
        unit = np.zeros(len(number), bool)
        unit[1:] = number[:-1] & np.isin(self.values[1:], _UNIT_HASHES)
        unit[self.of[:-1][self.of[:-1] < len(unit)]] = False
        self.kinds = np.select([number, unit, name], [1, 2, 3], 0).astype(np.int8)
        self.codes = np.select([number, unit, name], [NUMBER, UNIT, NAME], self.values)
        if form == FOLDED:
            self._fold()

    def _fold(self) -> None:
        """One token for each run of names within a text; its value is that of all of them."""
        named = self.kinds == 3
        keep = np.ones(len(named), bool)
        keep[1:] = ~(named[1:] & named[:-1])
        keep[self.of[:-1][self.of[:-1] < len(keep)]] = True
        at = np.flatnonzero(keep)
        if len(at):
            place = np.arange(len(keep)) - np.repeat(at, np.diff(np.append(at, len(keep))))
            self.values = mix(np.add.reduceat(self.values * (2 * place + 1).astype(np.uint64), at))
        self.of = np.concatenate([[0], np.cumsum(keep)])[self.of]
        self.starts, self.kinds = self.starts[at], self.kinds[at]
        self.codes = self.codes[at]

    def windows(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Hash, first token and number of plain tokens of every window that lies within one text."""
        grams = ngram_hashes(self.codes, WIDTH)
        counts = np.diff(self.of)
        stop = np.repeat(self.of[1:], counts)
        fits = (np.arange(len(self.codes)) + WIDTH <= stop)[:len(grams)]
        plain = np.concatenate([[0], np.cumsum(self.kinds == 0)])
        at = np.flatnonzero(fits)
        return grams[at], at, plain[at + WIDTH] - plain[at]


class Index:
    """Windows of some benchmark items, sorted by hash."""

    def __init__(self, items: list[tuple[int, str]], form: int = CASED):
        self.ids = [k for k, _ in items]
        self.form = form
        t = Template(pa.array([x for _, x in items], pa.string()), form)
        self.kinds, self.values, self.of = t.kinds, t.values, t.of
        grams, at, plain = t.windows()
        owner = np.searchsorted(t.of, at, side="right") - 1
        counted = plain >= PLAIN
        telling = np.zeros(len(items), bool)
        telling[owner[counted]] = True
        counted |= ~telling[owner]
        grams, at, owner = grams[counted], at[counted], owner[counted]
        self.short: dict[int, list[int]] = {}
        for k in np.flatnonzero((np.diff(t.of) < WIDTH) & (np.diff(t.of) > 0)).tolist():
            self.short.setdefault(int(np.diff(t.of)[k]), []).append(k)
        self.short_keys = {n: {int(ngram_hashes(t.codes[t.of[k]:t.of[k + 1]], n)[0]): [] for k in ks} for n, ks in self.short.items()}
        for n, ks in self.short.items():
            for k in ks:
                self.short_keys[n][int(ngram_hashes(t.codes[t.of[k]:t.of[k + 1]], n)[0])].append(k)
        order = np.argsort(grams, kind="stable")
        self.grams, self.at, self.owner = grams[order], at[order], owner[order]
        by_item = np.lexsort((grams, owner))
        grams, owner = grams[by_item], owner[by_item]
        fresh = np.ones(len(grams), bool)
        fresh[1:] = (grams[1:] != grams[:-1]) | (owner[1:] != owner[:-1])
        self.sizes = np.bincount(owner[fresh], minlength=len(items))
        self.lengths = np.diff(t.of)
        # A bit for the top 24 bits of every window turns away nearly all others in one step.
        self.sieve = np.zeros(1 << 24, bool)
        self.sieve[(self.grams >> np.uint64(40)).astype(np.int64)] = True

    def matches(self, t: Template, share: float) -> Iterator[tuple[int, int, int, float, float]]:
        """(text, item, windows, share, agreement) of every stretch with at least ``share`` and every alignment in it; a perfect one ends its pair."""
        grams, at, _ = t.windows()
        near = np.flatnonzero(self.sieve[(grams >> np.uint64(40)).astype(np.int64)])
        grams, at = grams[near], at[near]
        lo = np.searchsorted(self.grams, grams, side="left")
        n = np.searchsorted(self.grams, grams, side="right") - lo
        hit = np.repeat(np.arange(len(grams)), n)
        entry = np.repeat(lo - (np.cumsum(n) - n), n) + np.arange(n.sum())
        text = np.searchsorted(t.of, at[hit], side="right") - 1
        item, place = self.owner[entry], self.at[entry] - self.of[self.owner[entry]]
        start = at[hit] - t.of[text] - place
        order = np.lexsort((start, item, text))
        text, item, start, hit, entry = text[order], item[order], start[order], hit[order], entry[order]
        bound = np.flatnonzero(np.concatenate([[True], (text[1:] != text[:-1]) | (item[1:] != item[:-1]), [True]])) if len(text) else []
        for a, b in zip(bound[:-1], bound[1:]):
            k = int(item[a])
            span = max(2, self.lengths[k] // 2)
            starts = start[a:b]
            # Every stretch of alignments no wider than half the item.
            lead = np.flatnonzero(np.concatenate([[True], starts[1:] != starts[:-1]]))
            stop = np.searchsorted(starts, starts[lead] + span, side="right")
            own = stop - lead >= share * self.sizes[k]
            best = 0.0
            for c, d in zip((a + lead[own]).tolist(), (a + stop[own]).tolist()):
                found = len(np.unique(self.grams[entry[c:d]]))
                if found < share * self.sizes[k]:
                    continue
                for anchor in np.unique(start[c:d]).tolist():
                    same = self._agreement(t, at[hit[c:d]], self.at[entry[c:d]], np.abs(start[c:d] - anchor))
                    yield int(text[a]), k, found, found / self.sizes[k], same
                    best = max(best, same if found == self.sizes[k] else 0.0)
                    if best == 1.0:
                        break
                if best == 1.0:
                    break
        for n, keys in self.short_keys.items():
            grams = ngram_hashes(t.codes, n)
            wanted = np.array(sorted(keys), np.uint64)
            for p in np.flatnonzero(np.isin(grams, wanted)).tolist():
                k = int(np.searchsorted(t.of, p, side="right") - 1)
                if p + n <= t.of[k + 1]:
                    for item_k in keys[int(grams[p])]:
                        yield k, item_k, 1, 1.0, self._agreement(t, np.array([p]), np.array([self.of[item_k]]), np.zeros(1, np.int64), n)

    def _agreement(self, t: Template, there: np.ndarray, here: np.ndarray, away: np.ndarray, width: int = WIDTH) -> float:
        """Share of the slots whose value stands for one and the same value throughout; 1 without slots.

        Window pairs ``away`` from the alignment judged count only for item tokens that no nearer one has.
        """
        doc, own = (there[:, None] + np.arange(width)).ravel(), (here[:, None] + np.arange(width)).ravel()
        slot = self.kinds[own] > 0
        doc, own, far = doc[slot], own[slot], np.repeat(away, width)[slot]
        order = np.lexsort((doc, far, own))
        doc, own = doc[order], own[order]
        first = np.ones(len(own), bool)
        first[1:] = own[1:] != own[:-1]
        pairs = np.stack([doc[first], own[first]], 1)
        if not len(pairs):
            return 1.0
        votes: dict[int, dict[int, int]] = {}
        for a, b in pairs.tolist():
            of = votes.setdefault(int(self.values[b]), {})
            of[int(t.values[a])] = of.get(int(t.values[a]), 0) + 1
        return sum(max(of.values()) for of in votes.values()) / len(pairs)


def _all_matches(indexes: list[Index], column: pa.Array, share: float) -> Iterator[tuple[int, int, int, float, float]]:
    for index in indexes:
        yield from index.matches(Template(column, index.form), share)


def blocks(benchmark: DataFrame, block_windows: int = BLOCK_WINDOWS) -> Iterator[list[tuple[int, str]]]:
    """Items in lists of a bounded number of words; a longer item stands alone."""
    part, size = [], 0
    for row in benchmark.select("item_id", "text").filter("text IS NOT NULL").toLocalIterator():
        words = len(row.text) // 2 + 1
        if part and size + words > block_windows:
            yield part
            part, size = [], 0
        part.append((row.item_id, row.text))
        size += words
    if part:
        yield part


def _matcher(shared, share: float, agree: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        indexes = [Index(shared.value, form) for form in FORMS]
        for piece in slices(batches):
            best: dict[tuple[int, int], tuple] = {}
            for text, item, windows, part, same in _all_matches(indexes, piece.column("text"), share):
                if part >= share and same >= agree:
                    best[text, item] = max(best.get((text, item), (0, 0.0, 0.0)), (windows, part, same))
            rows = sorted(best)
            ids = piece.column("doc_id").take(pa.array([a for a, _ in rows], pa.int64()))
            found = [best[k] for k in rows]
            yield pa.record_batch(
                [ids, pa.array([indexes[0].ids[b] for _, b in rows], pa.int64()), pa.array([x[0] for x in found], pa.int64()),
                 pa.array([float(x[1]) for x in found], pa.float64()), pa.array([float(x[2]) for x in found], pa.float64())],
                ["doc_id", "item_id", "windows", "share", "slot_agreement"])

    return run


def contaminated(docs: DataFrame, benchmark: DataFrame, share: float = SHARE, agree: float = AGREE, block_windows: int = BLOCK_WINDOWS) -> DataFrame:
    """(doc_id, item_id, windows, share, slot_agreement): the benchmark items that documents hold."""
    texts = docs.select(F.col("doc_id"), F.col("text"))
    result = None
    for part in blocks(benchmark, block_windows):
        shared = docs.sparkSession.sparkContext.broadcast(part)
        found = texts.mapInArrow(_matcher(shared, share, agree), "doc_id long, item_id long, windows long, share double, slot_agreement double")
        result = found if result is None else result.union(found)
    if result is None:
        result = docs.sparkSession.createDataFrame([], "doc_id long, item_id long, windows long, share double, slot_agreement double")
    return result


def without_contaminated(docs: DataFrame, benchmark: DataFrame, share: float = SHARE, agree: float = AGREE, block_windows: int = BLOCK_WINDOWS) -> DataFrame:
    """The rows of ``docs``, all columns, that hold no benchmark item."""
    for part in blocks(benchmark, block_windows):
        docs = docs.mapInArrow(_filter(docs.sparkSession.sparkContext.broadcast(part), share, agree), docs.schema)
    return docs


def _filter(shared, share: float, agree: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        indexes = [Index(shared.value, form) for form in FORMS]
        for piece in slices(batches):
            keep = np.ones(piece.num_rows, bool)
            for text, _, _, part, same in _all_matches(indexes, piece.column("text"), share):
                if part >= share and same >= agree:
                    keep[text] = False
            yield piece.filter(pa.array(keep))

    return run
