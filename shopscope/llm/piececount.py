"""Word-piece counts by a linear longest-match automaton (operator 5).

Pieces are the byte strings of a public vocabulary. Words ``[^\\x20\\x09-\\x0D]+`` are matched each
with one blank before it, greedily from the left: the longest piece that fits, then on behind it. The automaton is
the vocabulary's trie with a failure link and a number of popped pieces per node: where a node has no child for the next byte,
the pieces that greedy matching has settled by then are counted and the walk goes on at the
link, without looking at a byte again. So a word costs time in its length and no piece is ever built.

All links are folded into one table of next node and pieces popped by (node, byte), and
the words of a slice walk it side by side, one byte per step, long words last. The vocabulary must
hold all 256 single bytes; every word can then be matched. Null and empty texts have no words and no pieces; words of
any length are walked; repeated rows are counted each.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from shopscope.llm.text import Words, slices


def byte_pieces(path: str) -> list[bytes]:
    """Pieces of a byte-level vocabulary file, as bytes."""
    # The format writes bytes that print as they are and shifts the others beyond 255, in order.
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    shifted = [b for b in range(256) if b not in plain]
    byte_of = {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(shifted)}
    with open(path, encoding="utf-8") as file:
        words = json.load(file)["model"]["vocab"]
    return [bytes(byte_of[c] for c in word) for word in words if all(c in byte_of for c in word)]


class Automaton:
    """``step[node * 256 + byte]``: next node and pieces popped on the way; ``rest[node]``: pieces popped at a word's end."""

    def __init__(self, pieces: list[bytes]):
        pieces = sorted(set(pieces) - {b""})
        if len({p for p in pieces if len(p) == 1}) != 256:
            raise ValueError("the vocabulary must hold every single byte")
        children: list[dict[int, int]] = [{}]
        parent, byte, is_piece = [0], [0], [False]
        for piece in pieces:
            node = 0
            for b in piece:
                child = children[node].get(b)
                if child is None:
                    child = len(children)
                    children[node][b] = child
                    children.append({})
                    parent.append(node)
                    byte.append(b)
                    is_piece.append(False)
                node = child
            is_piece[node] = True
        n = len(children)
        order, level = [], [0]
        while level:
            order += level
            level = [c for node in level for c in children[node].values()]
        link, pops = [0] * n, [0] * n
        for node in order[1:]:
            if is_piece[node]:
                # The node's text is a piece: pop it and start anew.
                link[node], pops[node] = 0, 1
                continue
            # Otherwise settle what the parent settles, then try the last byte from there.
            at, count = link[parent[node]], pops[parent[node]]
            while byte[node] not in children[at]:
                count += pops[at]
                at = link[at]
            link[node], pops[node] = children[at][byte[node]], count
        self.step = np.zeros((n, 256), np.int32)
        self.popped = np.zeros((n, 256), np.uint8)
        for node in order:
            if node:
                # Without a child the walk goes on as the linked node would, after popping.
                self.step[node] = self.step[link[node]]
                self.popped[node] = np.minimum(self.popped[link[node]].astype(np.int64) + pops[node], 255)
            for b, child in children[node].items():
                self.step[node, b], self.popped[node, b] = child, 0
        rest = np.zeros(n, np.int64)
        for node in order[1:]:
            rest[node] = pops[node] + rest[link[node]]
        self.rest = rest
        if n and self.popped.max() == 255:
            raise ValueError("a step pops more than 254 pieces")

    def count(self, buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Pieces of a blank and each span of bytes."""
        lengths = ends - starts
        order = np.argsort(-lengths, kind="stable")
        starts, lengths = starts[order], lengths[order]
        step, popped = self.step.reshape(-1), self.popped.reshape(-1)
        node = np.full(len(starts), step[32], np.int32)
        pieces = np.zeros(len(starts), np.int64)
        # Words still being walked are the first ones, as lengths fall.
        active = np.searchsorted(-lengths, -np.arange(1, (lengths[0] if len(lengths) else 0) + 1), side="right")
        for k, n in enumerate(active.tolist()):
            at = node[:n].astype(np.int64) * 256 + buf[starts[:n] + k]
            pieces[:n] += popped[at]
            node[:n] = step[at]
        pieces += self.rest[node]
        out = np.empty(len(pieces), np.int64)
        out[order] = pieces
        return out


_built: dict[str, Automaton] = {}


def automaton(path: str) -> Automaton:
    """The automaton of a vocabulary file, built once per worker."""
    if path not in _built:
        _built[path] = Automaton(byte_pieces(path))
    return _built[path]


def greedy_pieces(word: bytes, pieces: set[bytes]) -> list[bytes]:
    """The definition, for tests: longest piece first, from the left."""
    out, at = [], 0
    while at < len(word):
        end = len(word)
        while word[at:end] not in pieces:
            end -= 1
        out.append(word[at:end])
        at = end
    return out


def count_pieces(docs: DataFrame, vocabulary: str) -> DataFrame:
    """(doc_id, n_words, n_pieces) per row of ``docs``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = automaton(vocabulary)
        for piece in slices(batches):
            words = Words(piece.column("text"), lower=False)
            pieces = np.concatenate([[0], np.cumsum(machine.count(words.buf, words.starts, words.ends))])
            yield pa.record_batch(
                [piece.column("doc_id"), pa.array(words.counts), pa.array(pieces[words.of[1:]] - pieces[words.of[:-1]])],
                ["doc_id", "n_words", "n_pieces"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n_words long, n_pieces long")
