"""Exact and near duplicates against brute force."""

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from shopscope.llm import exact, neardup
from shopscope.llm.graph import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {k: k + 32 for k in range(65, 91)}


def shingle_set(text):
    words = WORD.findall((text or "").translate(LOWER))
    if len(words) < 5:
        return frozenset([tuple(words)]) if words else frozenset()
    return frozenset(tuple(words[k:k + 5]) for k in range(len(words) - 4))


def brute_components(rows, percent=85):
    sets = [shingle_set(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                root[find(a)] = find(b)
    least = {}
    for k, (doc_id, _) in enumerate(rows):
        least.setdefault(find(k), []).append(doc_id)
    pick = {k: min((i for i in ids if i is not None), default=None) for k, ids in least.items()}
    return [(doc_id, len(s), doc_id if not s else pick[find(k)]) for k, ((doc_id, _), s) in enumerate(zip(rows, sets))]


def varied(n, seed=3):
    """Families of texts with a few words changed, chains, copies, common passages and short texts."""
    rng = random.Random(seed)
    words = [f"w{k}" for k in range(400)]
    common = " ".join(rng.choices(words, k=30))
    rows = []
    for family in range(n):
        base = rng.choices(words, k=rng.choice([3, 6, 12, 40, 150]))
        for _ in range(rng.randint(1, 9)):
            text = list(base)
            for _ in range(rng.randint(0, max(1, len(text) // 30))):
                text[rng.randrange(len(text))] = rng.choice(words)
            rows.append((len(rows), " ".join(text) + (f" {common}" if family % 7 == 0 else "")))
            if rng.random() < 0.3:
                base = text
    return rows


def near_rows(df):
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in df.collect()), key=str)


@pytest.mark.parametrize("block, most_keys", [(1536, neardup.MOST_KEYS), (3, 0)])
def test_near_duplicates_match_all_pairs(texts, block, most_keys):
    rows = varied(60)
    got = near_rows(neardup.near_duplicates(texts(rows), block=block, most_keys=most_keys))
    assert got == sorted(brute_components(rows), key=str)


def test_dropping_does_not_depend_on_how_keys_travel(texts):
    rows = [*varied(30), (None, "a b c d e f g"), (None, "A b c d e f g"), (None, None), (3, "a b c d e f g"), (3, "other words are in this row")]
    docs = texts(rows)
    kept = [sorted((tuple(r) for r in neardup.without_near_duplicates(docs, most_keys=k).collect()), key=str) for k in (0, neardup.MOST_KEYS)]
    assert kept[0] == kept[1] and len(kept[0]) < len(rows) and (None, None) in {r[:2] for r in kept[0]}


def test_long_sets_are_blocks_of_their_own(texts, monkeypatch):
    monkeypatch.setattr(neardup, "SHINGLES", 1)
    words = [f"w{k}" for k in range(3000)]
    rows = [(k, " ".join([*words[:k * 3], f"x{k}", *words[k * 3 + 1:]])) for k in range(12)]
    assert near_rows(neardup.near_duplicates(texts(rows), block=64)) == sorted(brute_components(rows), key=str)


def test_near_duplicates_of_odd_rows(texts, odd):
    found = neardup.near_duplicates(texts(odd))
    assert near_rows(found) == sorted(brute_components(odd), key=str)
    assert found.filter("NOT kept").count() == 0


def test_near_duplicates_of_nothing(texts):
    assert neardup.near_duplicates(texts([])).count() == 0


def test_borrowed_registers_follow_similarity():
    rng = np.random.default_rng(1)
    agree = []
    for _ in range(60):
        both = rng.integers(0, 2**63, 24, dtype=np.uint64) * np.uint64(2)
        sets = [np.sort(both[:22]), np.sort(both[2:])]
        regs = neardup.sketch(np.concatenate(sets), np.repeat([0, 1], [22, 22]), 2)
        full = neardup.lend(regs)
        assert (full != neardup.EMPTY).all()
        agree.append((full[0] == full[1]).mean())
    assert abs(np.mean(agree) - 20 / 24) < 0.05


def test_estimate_is_near(spark):
    rng = np.random.default_rng(2)
    values = np.unique(rng.integers(0, 2**63, 6000, dtype=np.uint64) * np.uint64(2) + np.uint64(1))
    rng.shuffle(values)
    a, b = np.sort(values[:5000]), np.sort(values[500:5500])
    regs = neardup.sketch(np.concatenate([a, b]), np.repeat([0, 1], [len(a), len(b)]), 2)
    same = int((regs[0] == regs[1]).sum())
    got = neardup.estimate(np.array([same]), np.array([256]), np.array([len(a)]), np.array([len(b)]))[0]
    assert abs(got - 4500 / 5500) < 0.1


def test_components_of_a_long_path(spark):
    links = spark.createDataFrame([(k, k + 1) for k in range(300)] + [(500, 501), (501, 501)], "a long, b long")
    roots = {r.node: r.root for r in components(links).collect()}
    assert roots == {**{k: 0 for k in range(301)}, 500: 500, 501: 500}


def brute_exact(rows):
    groups = {}
    for doc_id, text in rows:
        groups.setdefault(text or "", []).append(doc_id)
    out = []
    for doc_id, text in rows:
        ids = groups[text or ""]
        keep = max((i for i in ids if i is not None), default=None)
        out.append((doc_id, keep, len(ids), doc_id == keep, hashlib.sha256((text or "").encode()).hexdigest()))
    return sorted(out, key=str)


def exact_rows(df):
    return sorted(((r.doc_id, r.keep_id, r.group_size, r.kept, r.text_sha256) for r in df.collect()), key=str)


@pytest.mark.parametrize("bits", [63, 2])
def test_exact_duplicates_also_with_collisions(texts, odd, bits):
    rng = random.Random(5)
    long = "".join(rng.choices("abcdefgh \n", k=60000))
    rows = [(10 + k, t) for k, t in enumerate([long, long, long + "x", "y" + long, long[:30000] + "z" + long[30000:], "short", "short", "short "])]
    rows += [(40 + k, f"text number {k % 13}") for k in range(60)]
    assert exact_rows(exact.duplicates(texts(rows + odd), bits=bits)) == brute_exact(rows + odd)


def test_exact_duplicates_of_nothing(texts):
    assert exact.duplicates(texts([])).count() == 0


def test_cuts_follow_content():
    rng = np.random.default_rng(4)
    body = rng.integers(32, 127, 200_000).astype(np.uint8)
    a, b = body, np.concatenate([rng.integers(32, 127, 777).astype(np.uint8), body])
    chunks = []
    for buf in (a, b):
        ends, _ = exact.cut(buf, np.array([0, len(buf)]))
        starts = np.concatenate([[0], ends[:-1]])
        assert ends[-1] == len(buf) and (ends - starts).max() <= exact.MOST
        chunks.append({bytes(buf[s:e]) for s, e in zip(starts, ends)})
    assert len(chunks[0] & chunks[1]) >= len(chunks[0]) - 3
    same = np.full(100_000, 65, np.uint8)
    assert (np.diff(exact.cut(same, np.array([0, len(same)]))[0]) >= exact.LEAST).all()


def test_exact_result_is_lazy_in_text(texts):
    rows = texts([(1, "a"), (2, "a")])
    assert [r.keep_id for r in exact.duplicates(rows).orderBy("doc_id").collect()] == [2, 2]
    assert exact.duplicates(rows).filter(F.col("kept")).count() == 1


def test_bands_follow_the_threshold():
    for percent in (50, 80, 85, 95):
        band = neardup.band_width(percent)
        assert (1 - (percent / 100) ** band) ** (neardup.REGISTERS // band) <= neardup.MISS
    rng = np.random.default_rng(6)
    for percent in (80, 85):
        lost = 0
        for _ in range(300):
            values = np.unique(rng.integers(0, 2**63, 400, dtype=np.uint64) * np.uint64(2))[:400]
            rng.shuffle(values)
            own = (400 - 400 * percent // 100) // 2
            a, b = np.sort(values[own:]), np.sort(values[:len(values) - own])
            keys = neardup.band_keys(neardup.sketch(np.concatenate([a, b]), np.repeat([0, 1], [len(a), len(b)]), 2), neardup.band_width(percent))
            lost += not (keys[0] == keys[1]).any()
        assert lost == 0


def test_pipeline_stage_matches_all_pairs_at_80(spark, texts):
    rng = random.Random(8)
    rows = varied(30)
    for size in (60, 100, 200):
        for _ in range(15):
            base = [f"v{rng.randrange(10**6)}" for _ in range(size)]
            rows.append((len(rows), " ".join(base)))
            # A changed tail of d words changes d shingles: similarity between 0.80 and 0.85.
            d = rng.randint(-(-(size - 4) * 15 // 185), (size - 4) * 20 // 180)
            rows.append((len(rows), " ".join(base[:-d] + [f"z{rng.randrange(10**6)}" for _ in range(d)])))
    want = {doc_id for doc_id, n, least in brute_components(rows, 80) if not n or doc_id == least}
    assert len(want) < len({doc_id for doc_id, n, least in brute_components(rows) if not n or doc_id == least})
    kept = corpus_pipeline.drop_near_duplicates(spark, texts(rows), "")
    assert sorted(r.doc_id for r in kept.collect()) == sorted(want)


def test_near_copies_under_null_and_repeated_ids(spark, texts):
    rng = random.Random(9)
    base = [[f"u{rng.randrange(10**6)}" for _ in range(150)] for _ in range(8)]
    copy = lambda k, at: " ".join([*base[k][:at], "other", *base[k][at + 1:]])
    plain = [" ".join(b) for b in base]
    rows = [
        (None, plain[0]), (None, copy(0, 0)), (None, copy(0, 149)),  # null ids only
        (None, plain[1]), (1, copy(1, 0)),  # a null copies a document
        (None, plain[2]),  # a null that copies nothing
        (7, plain[3]), (3, copy(3, 0)), (7, plain[4]),  # one id, two texts, one of them a copy
        (9, plain[5]), (9, plain[6]), (10, copy(5, 0)), (11, copy(6, 0)),  # both texts of an id have copies
    ]
    assert near_rows(neardup.near_duplicates(texts(rows))) == sorted(brute_components(rows), key=str)
    kept = [(r.doc_id, r.text) for r in corpus_pipeline.drop_near_duplicates(spark, texts(rows), "").collect()]
    nulls = {text for _, text in rows[:3]}
    assert len(nulls & {t for d, t in kept if d is None}) == 1
    assert sorted((r for r in kept if r[1] not in nulls), key=str) == sorted([rows[4], rows[5], rows[7], rows[8], rows[9], rows[10]], key=str)
