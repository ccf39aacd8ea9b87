"""Scoring by a hashed maximum-entropy language model (operator 3).

Tokens are the lower-cased (A-Z) words ``[^\\x20\\x09-\\x0D]+`` and one end per text. The model factors

    P(token | history) = P(class | history) * P(slot | class, history) * P(token | slot)

* A token's class comes from its last three bytes (``CLASSES`` classes, so any word has one, also an unseen one).
* Slots are the ``SLOTS - 1`` most frequent tokens of the class and one slot for its other tokens.
* The first two factors are softmaxes with hashed features: the word before, the one before that (a skip), both
  together, and the classes of the two words before. Each feature picks a row of a weight table.
* Within the slot of other tokens, P is (c + 1) / (sum of counts + distinct tokens + 1) of the class, where c is the token's count in
  training; the last 1 is the share of all unseen tokens. So all probabilities of a history add up to one.

Training: in each round every task takes Adagrad steps over minibatches of its share of the training texts,
from the weights all tasks start with, and returns the change; changes are averaged by tokens, piece by piece of the table, in a
shuffle, and applied. Each training text is in one round. Counts, N, V and every training text take part, nothing
is sampled. Scoring goes over all texts in slices: features are looked up and summed in numpy batches; counts of tokens
that are frequent (``HEAD``, a fixed number) are sent to all tasks, the rest are joined on the token's hash.

Tokens are told apart by a 64-bit hash. Null and empty texts have one token, the end. Rows are scored each; a null id counts as not held out.
Without training texts every token has the probability of an unseen one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopscope.llm.text import Words, distinct_hashes, hash_bytes, list_rows, mix, slices
from shopscope.session import stored

CLASSES = 32
SLOTS = 32
ROWS = 1 << 14
HEAD = 1 << 17
ROUNDS = 3
BATCH = 1 << 12
RATE = 0.1
PIECES = 64
END = np.uint64(hash_bytes(b"\x20end"))
START = np.uint64(hash_bytes(b"\x20start"))


class Tokens:
    """Tokens of some texts: hashes and classes in order, ends included; text k in ``of[k]`` to ``of[k + 1]``."""

    def __init__(self, column: pa.Array):
        words = Words(column)
        n = len(words.of) - 1
        lengths = words.ends - words.starts
        buf = words.buf
        # The class: a hash of the last three bytes, punctuation included.
        last = buf[words.ends - 1].astype(np.uint64) if len(words) else np.zeros(0, np.uint64)
        third = np.where(lengths > 2, buf[words.ends - np.minimum(lengths, 3)] if len(words) else 0, 0).astype(np.uint64)
        second = np.where(lengths > 1, buf[words.ends - np.minimum(lengths, 2)] if len(words) else 0, 0).astype(np.uint64)
        kinds = (mix(last | (second << np.uint64(8)) | (third << np.uint64(16))) >> np.uint64(40)) & np.uint64(CLASSES - 1)
        self.of = words.of + np.arange(n + 1)
        self.hashes = np.insert(words.hashes(), words.of[1:], END)
        self.classes = np.insert(kinds.astype(np.int64), words.of[1:], 0)
        self.n = np.diff(self.of)

    def features(self) -> list[np.ndarray]:
        """Row of each feature for every token: one before, one before that, both, their classes."""
        h, c = self.hashes, self.classes.astype(np.uint64)
        first = np.zeros(len(h), bool)
        first[self.of[:-1]] = True
        second = np.zeros(len(h), bool)
        second[np.minimum(self.of[:-1] + 1, len(h) - 1)] = True
        second |= first
        one, two = np.roll(h, 1), np.roll(h, 2)
        one[first], two[second] = START, START
        c1, c2 = np.roll(c, 1), np.roll(c, 2)
        c1[first], c2[second] = np.uint64(CLASSES), np.uint64(CLASSES)
        rows = np.uint64(ROWS - 1)
        pair = c1 * np.uint64(64) + c2
        return [(mix(one ^ np.uint64(1)) & rows).astype(np.int64), (mix(two ^ np.uint64(2)) & rows).astype(np.int64),
                (mix(one * np.uint64(3) + two) & rows).astype(np.int64), (mix(pair + np.uint64(1 << 32)) & rows).astype(np.int64)]


class Lookup:
    """Hashes to numbers: open addressing in numpy, all probes of a batch at once."""

    def __init__(self, keys: np.ndarray):
        self.bits = max(4, int(2 * len(keys) + 1).bit_length() + 1)
        self.keys = np.zeros(1 << self.bits, np.uint64)
        self.at = np.full(1 << self.bits, -1, np.int32)
        place = (keys >> np.uint64(64 - self.bits)).astype(np.int64)
        left = np.arange(len(keys), dtype=np.int64)
        while len(left):
            spot = place[left]
            free = self.at[spot] < 0
            taken, first = np.unique(spot[free], return_index=True)
            winner = left[free][first]
            self.at[taken], self.keys[taken] = winner, keys[winner]
            left = np.setdiff1d(left, winner, assume_unique=True)
            place[left] = (place[left] + 1) & ((1 << self.bits) - 1)

    def find(self, keys: np.ndarray) -> np.ndarray:
        out = np.full(len(keys), -1, np.int32)
        place = (keys >> np.uint64(64 - self.bits)).astype(np.int64)
        left = np.arange(len(keys))
        while len(left):
            spot = place[left]
            at = self.at[spot]
            same = (at >= 0) & (self.keys[spot] == keys[left])
            out[left[same]] = at[same]
            left = left[(at >= 0) & ~same]
            place[left] = (place[left] + 1) & ((1 << self.bits) - 1)
        return out


class Model:
    """Frequent tokens, class totals and the two weight tables."""

    def __init__(self, head: np.ndarray, counts: np.ndarray, classes: np.ndarray, totals: np.ndarray, types: np.ndarray):
        self.head, self.counts, self.classes = head, counts, classes
        self.lookup = Lookup(head)
        # Slots: the most frequent of each class.
        self.slot = np.full(len(head), SLOTS - 1, np.int64)
        order = np.lexsort((head, -counts, classes))
        rank = np.arange(len(head)) - np.searchsorted(classes[order], classes[order])
        named = order[rank < SLOTS - 1]
        self.slot[named] = rank[rank < SLOTS - 1]
        self.has_slot = np.zeros((CLASSES, SLOTS), bool)
        self.has_slot[classes[named], self.slot[named]] = True
        self.has_slot[:, SLOTS - 1] = True
        rest_total = totals - np.bincount(classes[named], weights=counts[named], minlength=CLASSES)
        rest_types = types - np.bincount(classes[named], minlength=CLASSES)
        #: log10 of the denominator within the slot of other tokens.
        self.rest = np.log10(rest_total + rest_types + 1)
        # Weights begin at the frequencies without a history, spread over the four features.
        share = (totals + 1) / (totals.sum() + CLASSES)
        self.class_bias = np.log(share).astype(np.float32)
        inside = np.zeros((CLASSES, SLOTS))
        inside[classes[named], self.slot[named]] = counts[named]
        inside[:, SLOTS - 1] = rest_total
        inside = np.log((inside + 0.5) / (inside + 0.5).sum(1, keepdims=True))
        self.slot_bias = np.where(self.has_slot, inside, -1e9).astype(np.float32)
        self.weights = np.zeros((2 * ROWS, CLASSES), np.float32)

    def parts(self, tokens: Tokens) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Number among the frequent tokens (or -1), class and slot of every token."""
        at = self.lookup.find(tokens.hashes)
        slot = np.where(at >= 0, self.slot[at] if len(self.head) else SLOTS - 1, SLOTS - 1)
        return at, tokens.classes, slot

    def logits(self, rows: list[np.ndarray], classes: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray], list[np.ndarray]]:
        """Softmax inputs over classes and over the slots of the token's class, and the table rows used."""
        first = rows
        # In the second table a feature's row also depends on the class.
        second = [ROWS + ((r + classes * 7919) & (ROWS - 1)) for r in (rows[0], rows[2])]
        a = self.class_bias + self.weights.take(first[0], axis=0)
        for r in first[1:]:
            a += self.weights.take(r, axis=0)
        b = self.slot_bias.take(classes, axis=0)
        for r in second:
            b += self.weights.take(r, axis=0)
        # A slot that no token has keeps its place at minus infinity.
        return a, b, first, second

    def logs(self, rows: list[np.ndarray], classes: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray], list[np.ndarray]]:
        """Log softmax over classes and over the slots of the token's class, and the table rows used."""
        a, b, first, second = self.logits(rows, classes)
        for x in (a, b):
            powers = x.copy()
            x -= _exponents(powers)
            x -= np.log(_row_sums(powers))
        return a, b, first, second

    def picked(self, rows: list[np.ndarray], classes: np.ndarray, slots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of ``logs`` only the token's own class and slot."""
        a, b, _, _ = self.logits(rows, classes)
        out, i = [], np.arange(len(classes))
        for x, column in ((a, classes), (b, slots)):
            own = x[i, column]
            own -= _exponents(x)[:, 0]
            own -= np.log(_row_sums(x)[:, 0])
            out.append(own)
        return out[0], out[1]

    def learn(self, tokens: Tokens, seen: np.ndarray) -> None:
        """Adagrad steps over the tokens, a batch at a time; ``seen`` holds the sums of squared steps per row."""
        _, classes, slots = self.parts(tokens)
        rows = tokens.features()
        for at in range(0, len(classes), BATCH):
            cut = slice(at, at + BATCH)
            c, s = classes[cut], slots[cut]
            grad_a, grad_b, first, second = self.logits([r[cut] for r in rows], c)
            for grad in (grad_a, grad_b):
                _exponents(grad)
                grad /= _row_sums(grad)
            grad_a[np.arange(len(c)), c] -= 1
            grad_b[np.arange(len(c)), s] -= 1
            for group, grad in ((first, grad_a), (second, grad_b)):
                index = np.concatenate(group).astype(np.uint16)  # 2 * ROWS numbers at most: sorted by radix
                order = np.argsort(index, kind="stable")
                index = index[order]
                starts = np.flatnonzero(np.concatenate([[True], index[1:] != index[:-1]]))
                sums = _run_sums(grad, order % len(c), starts)
                row = index[starts].astype(np.int64)
                seen[row] += _row_sums(sums ** 2)[:, 0] / np.float32(CLASSES)
                sums *= (np.float32(RATE) / np.sqrt(seen[row] + np.float32(1)))[:, None]
                np.subtract(self.weights.take(row, axis=0), sums, out=sums)
                self.weights[row] = sums

    def score(self, tokens: Tokens) -> tuple[np.ndarray, np.ndarray]:
        """log10 of the first two factors (and for frequent tokens of all three) per token; number among the frequent ones."""
        at, classes, slots = self.parts(tokens)
        rows = tokens.features()
        out = np.empty(len(classes))
        for k in range(0, len(classes), BATCH):
            cut = slice(k, k + BATCH)
            log_a, log_b = self.picked([r[cut] for r in rows], classes[cut], slots[cut])
            out[cut] = (log_a + log_b) / np.log(10)
        rest = slots == SLOTS - 1
        out[rest] -= self.rest[classes[rest]]
        common = rest & (at >= 0)
        out[common] += np.log10(self.counts[at[common]] + 1)
        return out, at


def _exponents(x: np.ndarray) -> np.ndarray:
    """Turns ``x`` into exponentials, each row less its largest, and returns those."""
    half = x.shape[1] // 2
    # Halves against halves, then along the rows of the turned half: long loops where max(1) runs a short one per row.
    top = np.ascontiguousarray(np.maximum(x[:, :half], x[:, half:]).T).max(0)[:, None]
    x -= top
    np.exp(x, out=x)
    return top


def _row_sums(x: np.ndarray) -> np.ndarray:
    return x @ np.ones((x.shape[1], 1), x.dtype)


def _run_sums(values: np.ndarray, order: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Sums of the rows ``values[order]`` over the runs that begin at ``starts``, added in pairs."""
    lengths = np.diff(np.append(starts, len(order)))
    # The first pairs are added as they are gathered, so that half of a run is not copied before.
    halves = (lengths + 1) >> 1
    first = np.cumsum(halves) - halves
    place = np.arange(halves.sum()) - np.repeat(first, halves)
    at = np.repeat(starts, halves) + 2 * place
    sums = values.take(order[at], axis=0)
    left = np.repeat(halves, halves) - place
    pair = np.flatnonzero((left > 1) | np.repeat((lengths & 1) == 0, halves))
    sums[pair] = sums.take(pair, axis=0) + values.take(order[at[pair] + 1], axis=0)
    step, at = 1, np.flatnonzero(((place & 1) == 0) & (left > 1))
    while len(at):
        sums[at] = sums.take(at, axis=0) + sums.take(at + step, axis=0)
        step *= 2
        at = at[((place[at] & (2 * step - 1)) == 0) & (left[at] > step)]
    return sums.take(first, axis=0)


def held_out(doc_id: str = "doc_id") -> F.Column:
    """Rows that never train: crc32 of the id as text leaves 2 when divided by 7."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 7 == 2, F.lit(False))


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for piece in slices(batches, limit=8 << 20):
        tokens = Tokens(piece.column("text"))
        values, first, which = distinct_hashes(tokens.hashes)
        counts = np.bincount(which, minlength=len(values))
        yield pa.record_batch([pa.array(values.view(np.int64)), pa.array(tokens.classes[first].astype(np.int32)), pa.array(counts)],
                              ["token", "class", "n"])


def frequent_from(counts: DataFrame, most: int = HEAD) -> int:
    """The least count from which on there are at most ``most`` tokens, to a 64th of a power of two.

    Counts are tallied by their logarithm, so a few thousand numbers reach the driver at any size.
    """
    step = F.floor(F.log2("n") * 64)
    tally = counts.groupBy(step.alias("step")).agg(F.count(F.lit(1)).alias("tokens"), F.min("n").alias("n")).collect()
    total, least = 0, 1 << 62
    for row in sorted(tally, key=lambda r: -r.step):
        total += row.tokens
        if total > most:
            break
        least = row.n
    return least


def _learner(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        start = model.weights.copy()
        seen = np.zeros(len(start), np.float32)
        learned = 0
        for piece in slices(batches):
            tokens = Tokens(piece.column("text"))
            model.learn(tokens, seen)
            learned += len(tokens.hashes)
        change = (model.weights - start).reshape(PIECES, -1) * np.float32(learned)
        model.weights[:] = start  # the worker may serve another task
        if learned:
            touched = (seen > 0).reshape(PIECES, -1) * float(learned)
            yield pa.record_batch(
                [pa.array(np.arange(PIECES, dtype=np.int32)), pa.array([c.tobytes() for c in change], pa.binary()),
                 pa.array([t.astype(np.float32).tobytes() for t in touched], pa.binary())], ["piece", "change", "tokens"])

    return run


def _averages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of the changes and tokens per piece, in the memory of one table at most."""
    sums: dict[int, list[np.ndarray]] = {}
    for batch in batches:
        for piece, change, tokens in zip(*(c.to_pylist() for c in batch.columns)):
            change, tokens = np.frombuffer(change, np.float32), np.frombuffer(tokens, np.float32)
            if piece in sums:
                sums[piece][0] += change
                sums[piece][1] += tokens
            else:
                sums[piece] = [change.astype(np.float64), tokens.astype(np.float64)]
    if sums:
        means = [(c.reshape(len(t), -1) / np.maximum(t, 1)[:, None]).astype(np.float32).tobytes() for c, t in sums.values()]
        yield pa.record_batch([pa.array(list(sums), pa.int32()), pa.array(means, pa.binary())], ["piece", "mean"])


def train(docs: DataFrame, rounds: int = ROUNDS) -> tuple[Model, DataFrame, int, int]:
    """The model, the (token, class, n) table of the training texts, N and V. ``docs`` are the training texts. Runs jobs."""
    spark = docs.sparkSession
    texts = docs.select("doc_id", "text")
    counts = stored(texts.mapInArrow(_counts, "token long, class int, n long").groupBy("token", "class").agg(F.sum("n").alias("n")), "counts")
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count(F.lit(1)).alias("v")).first()
    per_class = {r["class"]: r for r in counts.groupBy("class").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("v")).collect()}
    head = counts.filter(F.col("n") >= frequent_from(counts)).toPandas()
    model = Model(head["token"].to_numpy(np.int64).view(np.uint64), head["n"].to_numpy(np.int64), head["class"].to_numpy(np.int64),
                  np.array([per_class[k].n if k in per_class else 0 for k in range(CLASSES)], np.float64),
                  np.array([per_class[k].v if k in per_class else 0 for k in range(CLASSES)], np.float64))
    for k in range(rounds if total.n else 0):
        shared = spark.sparkContext.broadcast(model)
        share = texts.filter(F.pmod(F.xxhash64("doc_id"), F.lit(rounds)) == k)
        changes = share.mapInArrow(_learner(shared), "piece int, change binary, tokens binary")
        means = changes.repartition("piece").mapInArrow(_averages, "piece int, mean binary").collect()
        flat = model.weights.reshape(PIECES, -1)
        for row in means:
            flat[row["piece"]] += np.frombuffer(row["mean"], np.float32)
        shared.unpersist()
    return model, counts, int(total.n), int(total.v)


def _scorer(shared, n: int, v: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        logs = np.log10(model.counts + 1)
        for piece in slices(batches):
            tokens = Tokens(piece.column("text"))
            per_token, at = model.score(tokens)
            text = np.repeat(np.arange(piece.num_rows), tokens.n)
            common = at >= 0
            base = np.where(common, logs[at] if len(logs) else 0.0, 0.0)
            sums = [np.bincount(text, weights=x, minlength=piece.num_rows) for x in (base, per_token, common)]
            # Rare tokens, each once per text with its count, for the join.
            owner, token = text[~common], tokens.hashes[~common]
            order = np.lexsort((token, owner))
            owner, token = owner[order], token[order]
            first = np.ones(len(token), bool)
            first[1:] = (token[1:] != token[:-1]) | (owner[1:] != owner[:-1])
            starts = np.flatnonzero(first)
            times = np.diff(np.append(starts, len(token)))
            rare = np.bincount(owner[starts], minlength=piece.num_rows)
            yield pa.record_batch(
                [piece.column("doc_id"), pa.array(tokens.n), pa.array(sums[0] - tokens.n * np.log10(n + v + 1.0)), pa.array(sums[1]),
                 pa.array(sums[2].astype(np.int64)), list_rows(token[starts].view(np.int64), rare), list_rows(times.astype(np.int32), rare)],
                ["doc_id", "n_tokens", "base", "score", "common", "rare", "times"])

    return run


def score(docs: DataFrame, model: Model, counts: DataFrame, n: int, v: int) -> DataFrame:
    """(doc_id, n_tokens, n_known, train_tokens, base_score, score) per row. Runs jobs."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = "doc_id long, n_tokens long, base double, score double, common long, rare array<long>, times array<int>"
    rows = docs.select("doc_id", "text").mapInArrow(_scorer(shared, n, v), schema)
    rows = stored(rows.withColumn("row", F.monotonically_increasing_id()), "scored")
    least = int(model.counts.min()) if len(model.counts) else 0
    each = rows.select("row", F.explode(F.arrays_zip("rare", "times")).alias("r")).select(
        "row", F.col("r.rare").alias("rare"), F.col("r.times").alias("times"))
    # Only tokens that can be missing from the frequent ones; a token's row is one, so the join cannot multiply.
    known = each.join(counts.filter(F.col("n") <= least), F.col("rare") == F.col("token"))
    gain = known.groupBy("row").agg(F.sum(F.col("times") * F.log10(F.col("n") + 1)).alias("gain"), F.sum("times").alias("found")).withColumnRenamed("row", "at")
    joined = rows.drop("rare", "times").join(gain, F.col("row") == F.col("at"), "left")
    more = F.coalesce("gain", F.lit(0.0))
    return joined.select(
        "doc_id", "n_tokens", (F.col("common") + F.coalesce("found", F.lit(0))).alias("n_known"), F.lit(n).cast("long").alias("train_tokens"),
        (F.col("base") + more).alias("base_score"), (F.col("score") + more).alias("score"))
