"""URL rules in a sorted digest array (operator 10).

A rule is a host, a slash and a path prefix (``example.org/es/``) with a verdict. The
array file holds the rules' 64-bit xxhash keys in order, the place of each rule's text and verdict, and the texts. A task
memory-maps the file, hashes every host suffix of a URL joined to every path prefix, both of lengths that
occur among the rules (so hosts and paths of any length cost no more than the rules' own lengths), finds the keys with one vectorised binary search per batch, and
compares the text behind each hit, so a hash collision cannot decide. The longest rule that fits wins; among
rules of the same length the one with the longer host.

The file is written to the shared folder and Spark hands it to every executor (``addFile``), also to one
that replaces a lost one. Lists beyond ``part_bytes`` become several files, each probed in a pass of its own over what
the URLs need, and the longest hit of all passes wins; a file never exceeds that bound. Rules reach the driver one part at a time.

Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased. Path: from there up to ``?``, ``#``
or the end. A URL that is null or has no ``://`` has empty host and path and meets no rule. URLs that meet no rule
get ``default``; repeated URLs are judged each. Rules with an unknown verdict or without a slash are refused; repeated rules must agree.
"""

from __future__ import annotations

import os
import struct
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopscope.session import scratch_dir

MAGIC = b"URLDIG02"
VERDICTS = ("allow", "block")
PART_BYTES = 64 << 20


def encode(rules: list[tuple[str, str]]) -> bytes:
    """The file: magic, number of rules, lengths of hosts and of path prefixes, keys, text bounds, verdicts, texts."""
    known: dict[str, str] = {}
    for rule, verdict in rules:
        if rule is None or "/" not in rule or verdict not in VERDICTS:
            raise ValueError(f"not a rule: {rule!r} {verdict!r}")
        host, _, path = rule.partition("/")
        rule = f"{host.translate(_TO_LOWER)}/{path}"
        if known.setdefault(rule, verdict) != verdict:
            raise ValueError(f"two verdicts for {rule!r}")
    texts = [r.encode() for r in known]
    keys = np.array([xxhash.xxh64_intdigest(t) for t in texts], np.uint64)
    order = np.argsort(keys, kind="stable")
    texts = [texts[k] for k in order]
    verdicts = np.array([VERDICTS.index(known[t.decode()]) for t in texts], np.uint8)
    bounds = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
    lengths = np.unique([len(t) - t.index(b"/") for t in texts]).astype(np.int64)
    hosts = np.unique([t.index(b"/") for t in texts]).astype(np.int64)
    return b"".join([MAGIC, struct.pack("<qqq", len(texts), len(hosts), len(lengths)), hosts.tobytes(), lengths.tobytes(), keys[order].tobytes(),
                     bounds.tobytes(), verdicts.tobytes(), *texts])


class DigestArray:
    """A memory-mapped rule file."""

    def __init__(self, path: str):
        data = np.memmap(path, np.uint8, "r")
        if bytes(data[:8]) != MAGIC:
            raise ValueError(f"{path} is not a rule file")
        n, h, m = struct.unpack("<qqq", bytes(data[8:32]))
        at = 32
        self.host_lengths = data[at:at + 8 * h].view(np.int64).tolist()
        at += 8 * h
        self.path_lengths = data[at:at + 8 * m].view(np.int64).tolist()
        at += 8 * m
        self.keys = data[at:at + 8 * n].view(np.uint64)
        at += 8 * n
        self.bounds = data[at:at + 8 * (n + 1)].view(np.int64)
        at += 8 * (n + 1)
        self.verdicts = data[at:at + n]
        self.texts = data[at + n:]

    def __len__(self) -> int:
        return len(self.keys)

    def find(self, texts: list[bytes]) -> np.ndarray:
        """Index of the rule equal to each text, or -1."""
        found = np.full(len(texts), -1, np.int64)
        if not len(self) or not texts:
            return found
        probes = np.array([xxhash.xxh64_intdigest(t) for t in texts], np.uint64)
        first = np.searchsorted(self.keys, probes)
        for k in np.flatnonzero(self.keys[np.minimum(first, len(self) - 1)] == probes):
            at = int(first[k])
            while at < len(self) and self.keys[at] == probes[k]:  # all rules that share the key
                if bytes(self.texts[self.bounds[at]:self.bounds[at + 1]]) == texts[k]:
                    found[k] = at
                    break
                at += 1
        return found

    def best(self, hosts: list[str], paths: list[str]) -> tuple[list[str | None], list[str | None]]:
        """Longest fitting rule of each host and path, and its verdict."""
        probes: list[bytes] = []
        owner: list[int] = []
        for k, (host, path) in enumerate(zip(hosts, paths)):
            if not host:
                continue
            raw, name = path.encode(), host.encode()
            prefixes = [raw[:n] for n in self.path_lengths if n <= len(raw)]
            for n in self.host_lengths:
                at = len(name) - n
                # The host itself, or what follows a dot.
                if at == 0 or at > 0 and name[at - 1] == 0x2E:
                    probes += [name[at:] + p for p in prefixes]
                    owner += [k] * len(prefixes)
        rules: list[str | None] = [None] * len(hosts)
        verdicts: list[str | None] = [None] * len(hosts)
        rank: dict[int, tuple[int, int]] = {}
        for p, at in enumerate(self.find(probes).tolist()):
            if at >= 0:
                text = probes[p]
                score = (len(text), text.index(b"/"))
                if score > rank.get(owner[p], (-1, -1)):
                    rank[owner[p]] = score
                    rules[owner[p]] = text.decode()
                    verdicts[owner[p]] = VERDICTS[self.verdicts[at]]
        return rules, verdicts


_TO_LOWER = {k: k + 32 for k in range(65, 91)}
_open: dict[str, DigestArray] = {}


def _array(name: str) -> DigestArray:
    if name not in _open:
        _open[name] = DigestArray(SparkFiles.get(name))
    return _open[name]


def publish(spark: SparkSession, rules: list[tuple[str, str]]) -> str:
    """Write a rule file to the shared folder, hand it to all executors and return its name."""
    name = f"rules-{uuid.uuid4().hex}.bin"
    place = f"{scratch_dir(spark)}/{name}"
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(place)
    out = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(path, True)
    data = encode(rules)
    for at in range(0, len(data), 1 << 20):
        out.write(bytearray(data[at:at + (1 << 20)]))
    out.close()
    spark.sparkContext.addFile(path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(path).toString())
    return name


def parts(rules: DataFrame, part_bytes: int = PART_BYTES) -> Iterator[list[tuple[str, str]]]:
    """The rules in lists of bounded size, without holding more than one list."""
    part, size = [], 0
    for row in rules.select("rule", "verdict").distinct().toLocalIterator():
        cost = 17 + len((row.rule or "").encode())
        if part and size + cost > part_bytes:
            yield part
            part, size = [], 0
        part.append((row.rule, row.verdict))
        size += cost
    if part:
        yield part


def split_url(url: str) -> tuple[F.Column, F.Column]:
    """Host and path of a URL column."""
    after = F.regexp_extract(F.coalesce(F.col(url), F.lit("")), r"(?s)^.*?://(.*)$", 1)
    host = F.translate(F.regexp_extract(after, r"(?s)^([^/?#]*)", 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return host, F.regexp_extract(after, r"(?s)^[^/?#]*([^?#]*)", 1)


def judge(pages: DataFrame, rules: DataFrame, key: str = "page_id", url: str = "url", default: str = "allow", part_bytes: int = PART_BYTES) -> DataFrame:
    """(key, host, path, rule, verdict) per row of ``pages``; ``rules`` has columns rule and verdict."""
    host, path = split_url(url)
    result = pages.select(F.col(key), host.alias("host"), path.alias("path"), F.lit(None).cast("string").alias("rule"),
                          F.lit(None).cast("string").alias("verdict"))
    for part in parts(rules, part_bytes):
        result = result.mapInArrow(_prober(publish(pages.sparkSession, part)), result.schema)
    return result.withColumn("verdict", F.coalesce("verdict", F.lit(default)))


def _prober(name: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        array = _array(name)
        for batch in batches:
            rules, verdicts = batch.column("rule").to_pylist(), batch.column("verdict").to_pylist()
            more = array.best(batch.column("host").to_pylist(), batch.column("path").to_pylist())
            for k, (rule, verdict) in enumerate(zip(*more)):
                score = lambda r: (len(r.encode()), r.index("/"))
                if rule is not None and (rules[k] is None or score(rule) > score(rules[k])):
                    rules[k], verdicts[k] = rule, verdict
            yield pa.record_batch([*batch.columns[:3], pa.array(rules, pa.string()), pa.array(verdicts, pa.string())], batch.schema.names)

    return run
