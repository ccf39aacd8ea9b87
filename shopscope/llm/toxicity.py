"""Toxicity by subword bags (operator 4).

A word, lower-cased and bracketed (``<word>``), is the bag of its byte n-grams of three to six and
itself; every n-gram is hashed to a row of an embedding table, so an unseen misspelling shares most of its vectors with
the word it came from. The vectors of a window of eight words (windows overlap by half) are averaged and go
through a linear softmax of two classes; the text takes its most toxic window, since a few words among
thousands make a text toxic and an average over the text would drown them. Embeddings and
softmax are trained jointly: each step, the gradient of the text's loss flows through its windows, weighted by
how much each one leads, into the vectors (Adagrad). The last step fits slope and offset so that
the score is the share of toxic texts in the labels.

Training reads a bounded sample of the labelled rows: at most ``most_rows`` rows, in the order of a hash of the id,
toxic and clean in equal parts; their whole texts. It runs as one task whose size is bounded by that.
Everything else covers all rows. Because softmax after averaging is linear, an n-gram's vector is folded into one number and
scoring is a look-up per n-gram, over a slice of texts at once.

Null and empty texts get the score of a text without words, the offset's. Rows without a label, or a null id in
``labels``, do not train; without labels of both kinds every score is the share of toxic labels (0 without labels).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopscope.llm.text import Words, give_back, mix, slices, small_batches, span_bytes
from shopscope.session import stored

BUCKETS = 1 << 18
DIM = 8
WINDOW = 8
SIZES = (3, 4, 5, 6)
MOST_ROWS = 4000
#: Distinct words whose subwords training holds at once.
BLOCK = 1 << 14
SHARPNESS = 3.0
THRESHOLD = 0.3


def subwords(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of every subword of every word, and which word it belongs to.

    Subwords are the n-grams of the bracketed word and the whole word.
    """
    lengths = words.ends - words.starts
    # All words in one array, each as <word>.
    bounds = np.concatenate([[0], np.cumsum(lengths + 2)])
    tape = np.empty(bounds[-1], np.uint64)
    tape[bounds[:-1]], tape[bounds[1:] - 1] = 256, 257
    inner = np.ones(len(tape), bool)
    inner[bounds[:-1]] = inner[bounds[1:] - 1] = False
    source = np.repeat(words.starts - (np.cumsum(lengths) - lengths), lengths) + np.arange(lengths.sum())
    tape[inner] = words.buf[source]
    owner = np.repeat(np.arange(len(lengths), dtype=np.int32), lengths + 2)
    buckets, owners = [], []
    for n in SIZES:
        m = max(0, len(tape) - n + 1)
        code = tape[:m].copy()
        for k in range(1, n):
            code = code * np.uint64(0x100000001B3) + tape[k:k + m]
        own = owner[:m] == owner[n - 1:n - 1 + m] if m else np.zeros(0, bool)
        code = code[own] ^ np.uint64(n << 56)
        buckets.append((mix(code) >> np.uint64(46)).astype(np.int32))
        owners.append(owner[:m][own])
    buckets.append((words.hashes() >> np.uint64(46)).astype(np.int32))
    owners.append(np.arange(len(lengths), dtype=np.int32))
    return np.concatenate(buckets), np.concatenate(owners)


def windows(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First word, end and text of every window; steps of half a window, the last one shorter."""
    step = WINDOW // 2
    counts = np.where(words.counts > 0, np.maximum(1, -(-(words.counts - step) // step)), 0)
    text = np.repeat(np.arange(len(counts)), counts)
    rank = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    first = words.of[:-1][text] + rank * step
    return first, np.minimum(first + WINDOW, words.of[1:][text]), text


def span_sums(values: np.ndarray, first: np.ndarray, end: np.ndarray) -> np.ndarray:
    sums = np.concatenate([np.zeros((1, *values.shape[1:]), np.float64), np.cumsum(values, axis=0, dtype=np.float64)])
    return sums[end] - sums[first]


def text_max(values: np.ndarray, text: np.ndarray, n: int, empty: float) -> np.ndarray:
    out = np.full(n, -np.inf)
    if len(values):
        starts = np.flatnonzero(np.concatenate([[True], text[1:] != text[:-1]]))
        out[text[starts]] = np.maximum.reduceat(values, starts)
    return np.where(np.isinf(out), empty, out)


def bag(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the subwords of each word, word after word, and how many each word has; memory follows the block and the result."""
    lengths = ends - starts
    tape = span_bytes(buf, starts, lengths)
    bounds = np.concatenate([[0], np.cumsum(lengths)])
    buckets, counts = [np.zeros(0, np.int32)], [np.zeros(0, np.int64)]
    for at in range(0, len(starts), BLOCK):
        cut = bounds[at:at + BLOCK + 1]
        some = Words(pa.array([], pa.string()))
        some.buf, some.starts, some.ends = tape[cut[0]:cut[-1]], cut[:-1] - cut[0], cut[1:] - cut[0]
        bucket, owner = subwords(some)
        buckets.append(bucket[np.argsort(owner, kind="stable")])
        counts.append(np.bincount(owner, minlength=len(cut) - 1))
    return np.concatenate(buckets), np.concatenate(counts)


class Bags:
    """The bags of distinct words, read and written in blocks of words so that no array of all subwords is made beside ``bucket``."""

    def __init__(self, bucket: np.ndarray, counts: np.ndarray):
        # Buckets in use, numbered in order.
        present = np.bincount(bucket, minlength=BUCKETS) > 0
        self.used = np.flatnonzero(present)
        self.bucket = (np.cumsum(present, dtype=np.int32) - np.int32(1))[bucket]
        self.counts = counts
        self.bounds = np.concatenate([[0], np.cumsum(counts)])

    def _blocks(self) -> Iterator[tuple[slice, np.ndarray, np.ndarray]]:
        for at in range(0, len(self.counts), BLOCK):
            bounds = self.bounds[at:at + BLOCK + 1]
            yield slice(at, at + len(bounds) - 1), bounds[:-1] - bounds[0], self.bucket[bounds[0]:bounds[-1]]

    def sums(self, weight: np.ndarray) -> np.ndarray:
        """Sum of the weights of each word's buckets."""
        out = np.empty(len(self.counts), weight.dtype)
        for words, starts, bucket in self._blocks():
            out[words] = np.add.reduceat(weight[bucket], starts)
        return out

    def spread(self, pull: np.ndarray) -> np.ndarray:
        """Sum per bucket of the pull of its words."""
        out = np.zeros(len(self.used))
        for words, _, bucket in self._blocks():
            out += np.bincount(bucket, weights=np.repeat(pull[words], self.counts[words]), minlength=len(out))
        return out


def train(texts: pa.Array, labels: np.ndarray, prior: float, steps: int = 60, rate: float = 0.5, seed: int = 7):
    """(weight per bucket, slope, offset, value of a text without windows)."""
    words = Words(texts)
    # A word's subwords are the same wherever it stands: work on distinct words.
    hashes, first_at, word_of = np.unique(words.hashes(), return_index=True, return_inverse=True)
    word_of = word_of.astype(np.int32)
    bags = Bags(*bag(words.buf, words.starts[first_at], words.ends[first_at]))
    words.buf = words.starts = words.ends = None  # windows need the bounds of the texts only
    used, per_word = bags.used, bags.counts.astype(np.float32)
    distinct = len(hashes)
    del hashes, first_at
    give_back()
    first, end, text = windows(words)
    n = np.maximum(1, span_sums(per_word[word_of], first, end))
    text_starts = np.flatnonzero(np.concatenate([[True], text[1:] != text[:-1]])) if len(text) else np.zeros(0, int)
    present = text[text_starts]
    size = np.diff(np.concatenate([text_starts, [len(text)]]))
    y = labels[present].astype(np.float64)
    rng = np.random.default_rng(seed)
    table = rng.normal(0, 0.05, (len(used), DIM)).astype(np.float32)
    out = rng.normal(0, 0.3, DIM)  # difference of the two classes' softmax weights
    bias = 0.0
    seen_table = np.full(table.shape, 1e-6, np.float32)
    seen_out, seen_bias = np.full(DIM, 1e-6), 1e-6
    for _ in range(steps):
        # The softmax is linear in the averaged vectors, so averaging each vector's product with its weights gives the same logit.
        value = bags.sums(table @ out)
        logit = span_sums(value[word_of], first, end) / n + bias
        # Weight of each window within its text: softmax of its logit.
        top = np.repeat(np.maximum.reduceat(logit, text_starts), size)
        lead = np.exp(SHARPNESS * (logit - top))
        lead /= np.repeat(np.add.reduceat(lead, text_starts), size)
        text_logit = np.add.reduceat(lead * logit, text_starts)
        error = 1 / (1 + np.exp(-text_logit)) - y
        pull = np.repeat(error, size) * lead / len(y)
        # Each window's pull goes to its words, and from there to their subwords.
        per_window = pull / n
        size_of = len(word_of) + 1
        edge = np.bincount(first, weights=per_window, minlength=size_of) - np.bincount(end, weights=per_window, minlength=size_of)
        per_distinct = np.bincount(word_of, weights=np.cumsum(edge[:-1]), minlength=distinct)
        per_bucket = bags.spread(per_distinct)
        grad_out = per_bucket @ table
        grad_table = (per_bucket[:, None] * out).astype(np.float32)
        seen_table += grad_table ** 2
        table -= (rate * grad_table / np.sqrt(seen_table)).astype(np.float32) * 0.2
        seen_out += grad_out ** 2
        out -= rate * grad_out / np.sqrt(seen_out)
        seen_bias += pull.sum() ** 2
        bias -= rate * pull.sum() / np.sqrt(seen_bias)
    weight = np.zeros(BUCKETS, np.float32)
    weight[used] = table @ out
    value = bags.sums(weight[used])
    logit = span_sums(value[word_of], first, end) / n
    empty = float(np.median(logit))
    best = text_max(logit, text, len(texts), empty)
    slope, offset = calibrate(best, labels, prior)
    return weight, slope, offset, empty


def calibrate(value: np.ndarray, labels: np.ndarray, prior: float) -> tuple[float, float]:
    """Logistic slope and offset of the value, rows weighted to the share of toxic labels; Newton steps."""
    share = labels.mean()
    weight = np.where(labels == 1, prior / share, (1 - prior) / (1 - share))
    centre, spread = value.mean(), value.std() + 1e-9
    x = np.stack([(value - centre) / spread, np.ones(len(value))], 1)
    beta = np.array([1.0, np.log(prior / (1 - prior))])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        hess = (x * (weight * p * (1 - p))[:, None]).T @ x + np.eye(2) * 1e-3
        beta -= np.linalg.solve(hess, x.T @ (weight * (p - labels)) + 1e-3 * beta * [1, 0])
    return float(beta[0] / spread), float(beta[1] - beta[0] * centre / spread)


def fit(docs: DataFrame, labels: DataFrame, most_rows: int = MOST_ROWS) -> bytes | float:
    """The model as bytes, or the one score of all texts if the labels don't hold both kinds. Runs jobs.

    ``labels`` holds the rows to learn from: doc_id, toxic.
    """
    known = labels.filter("doc_id IS NOT NULL AND toxic IN (0, 1)").groupBy("doc_id").agg(F.max("toxic").alias("label"))
    counts = known.agg(F.count(F.lit(1)).alias("n"), F.sum("label").alias("toxic")).first()
    if not counts.n or counts.toxic in (0, counts.n):
        return float(bool(counts.n and counts.toxic))
    parts = [known.filter(F.col("label") == k).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most_rows // 2) for k in (0, 1)]
    picked = stored(parts[0].union(parts[1]).withColumnRenamed("doc_id", "labelled"), "picked")
    # At most most_rows ids, so this side can be sent to the scans.
    rows = docs.select("doc_id", "text").join(F.broadcast(picked), F.col("doc_id") == F.col("labelled")).groupBy("doc_id").agg(
        F.max("text").alias("text"), F.max("label").alias("label"))
    prior = counts.toxic / counts.n

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frames = list(batches)
        if frames:
            rows = pa.Table.from_batches(frames).sort_by("doc_id").combine_chunks()
            del frames
            labels = rows.column("label").to_numpy()
            if len(np.unique(labels)) == 2:
                weight, *rest = train(rows.column("text").chunk(0), labels, prior)
                model = np.array(rest, np.float64).tobytes() + weight.tobytes()
                del rows, weight
                give_back()
                yield pa.record_batch([pa.array([model], pa.binary())], ["model"])

    models = rows.coalesce(1).mapInArrow(run, "model binary").collect()
    return bytes(models[0].model) if models else float(prior)


class Model:
    def __init__(self, model: bytes | float):
        self.constant = model if isinstance(model, float) else None
        if self.constant is None:
            self.slope, self.offset, self.empty = np.frombuffer(model[:24], np.float64)
            self.weight = np.frombuffer(model[24:], np.float32)

    def scores(self, texts: pa.Array) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(texts), self.constant)
        words = Words(texts)
        bucket, owner = subwords(words)
        value = np.bincount(owner, weights=self.weight[bucket], minlength=len(words))
        number = np.bincount(owner, minlength=len(words))
        first, end, text = windows(words)
        logit = span_sums(value, first, end) / np.maximum(1, span_sums(number, first, end))
        best = text_max(logit, text, len(texts), self.empty)
        return 1 / (1 + np.exp(-np.clip(self.slope * best + self.offset, -30, 30)))


def score(docs: DataFrame, model: bytes | float) -> DataFrame:
    """(doc_id, score) per row."""
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ready = Model(shared.value)
        for piece in slices(batches):
            yield pa.record_batch([piece.column("doc_id"), pa.array(ready.scores(piece.column("text")))], ["doc_id", "score"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, score double")


def without_toxic(docs: DataFrame, model: bytes | float, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs``, all columns, whose score is below the threshold."""
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ready = Model(shared.value)
        for piece in slices(batches):
            yield piece.filter(pa.array(ready.scores(piece.column("text")) < threshold))

    return docs.mapInArrow(run, docs.schema)


def held_out(doc_id: str = "doc_id") -> F.Column:
    """Rows that never train: crc32 of the id as text leaves 2 when divided by 4."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 4 == 2, F.lit(False))


def fit_on(docs: DataFrame, labels: DataFrame, most_rows: int = MOST_ROWS) -> bytes | float:
    """Train on the labels that are not held out."""
    return fit(docs, labels.select("doc_id", "toxic").filter(~held_out()), most_rows)
