"""Divergence, packing and manifest against plain versions of the same."""

import bisect
import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from shopscope.llm import divergence, manifest, packing
from shopscope.llm.tables import vocabulary

LOW = {k: k + 32 for k in range(65, 91)}
TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, grp string, term string, rank int, at long, size string, part int, piece string"


@pytest.fixture(scope="module")
def table(spark):
    """Documents from (doc_id, text, lang, source, n_chars), with extra columns of clashing names."""
    return lambda rows, parts=3: spark.createDataFrame([(*r, "g", "t", 1, 2, "z", 3, "p") for r in rows], SCHEMA).repartition(parts)


def audit(rows, least=3, top=200):
    held, counts, sources = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for text, lang, source in rows:
        text, lang, source = text or "", lang or "", source or ""
        words = Counter(TERM.findall(text.translate(LOW)))
        sources[lang].add(source)
        held[lang].update(words.keys())
        counts[lang, source].update(words)
    out = []
    for lang, names in sources.items():
        kept = [t for t, n in held[lang].items() if n >= least]

        def shares(count):
            total = sum(count[t] for t in kept) + len(kept)
            return {t: 1 + 10**9 * (count[t] + 1) // total for t in kept}

        q = shares(sum((counts[lang, s] for s in names), Counter()))
        p = {s: shares(counts[lang, s]) for s in names}
        for s in names:
            pairs = [(-sum((p[s][t] - p[o][t]) ** 2 // p[o][t] for t in kept), o.encode()) for o in names if o != s]
            terms = [(-((p[s][t] - q[t]) ** 2 // q[t]), t.encode()) for t in kept if counts[lang, s][t] and p[s][t] > q[t]]
            for part, found in (("pair", sorted(pairs)), ("term", sorted(terms)[:top])):
                out += [(lang, s, part, item.decode(), -value, k + 1) for k, (value, item) in enumerate(found)]
    return sorted(out)


def test_audit_equals_brute_force_on_odd_rows(spark, table):
    rows = [(1, "Hello World hello", None, "a", 0), (1, "hello Ünï É", None, "b", 0), (None, "hello wörld", None, None, 0), (2, None, "x", "s", 0), (3, "", "x", "t", 0),
            (4, "y" * 3000, "z", "s", 0), (5, "y" * 3000, "z", "t", 0), (6, "y" * 3000 + " w", "z", "t", 0), (7, "y" * 2999, "z", "t", 0), (7, "y" * 2999, "z", "t", 0),
            (8, "12 [tie] tie_brk @", "x", "u", 0), *[(9, f"tie tea {'ten ' * k}", "x", f"u{k % 4}", 0) for k in range(9)]]
    assert sorted(tuple(r) for r in divergence.audit(table(rows)).collect()) == audit([(r[1], r[2], r[3]) for r in rows])
    assert divergence.audit(table([])).count() == 0


def test_audit_of_many_sources(spark, table):
    rng = random.Random(5)
    words = ["a" * k for k in range(1, 30)] + [f"{a}{b}" for a in "stuv" for b in ("", "x", "xyz", "é", "longer")]
    rows = [(k, " ".join(rng.choices(words, k=rng.randrange(12))), rng.choice("pq"), f"s{min(rng.randrange(40), 20)}", 0) for k in range(300)]
    for least, top in ((3, 200), (1, 2), (40, 5)):
        assert sorted(tuple(r) for r in divergence.audit(table(rows), least, top=top).collect()) == audit([(r[1], r[2], r[3]) for r in rows], least, top)


def test_refinement_discards_by_prefix(spark, table):
    """A prefix that fails ends there: no level looks at what is longer."""
    rows = [(k, f"common{'x' * 40}{chr(97 + k)} rare{'abcdefgh'[k % 8] * 30} {'junk' if k < 2 else 'fine'}", "l", "s", 0) for k in range(16)]
    local = divergence.local_counts(table(rows))
    assert {bytes(r.term) for r in divergence.kept_terms(local).collect()} == {b"fine"}
    for most_sent in (0, divergence.MOST_SENT):
        found = {bytes(r.term) for r in divergence.kept_terms(local, least=2, most_sent=most_sent).collect()}
        assert found == {b"fine", b"junk", *(b"rare" + c.encode() * 30 for c in "abcdefgh")}


def best_fit_decreasing(lengths, capacity):
    """Sequences that best fit opens, one piece at a time."""
    gaps, opened = [], 0
    for n in sorted(lengths, reverse=True):
        at = bisect.bisect_left(gaps, n)
        if at < len(gaps):
            left = gaps.pop(at) - n
        else:
            opened, left = opened + 1, capacity - n
        bisect.insort(gaps, left)
    return opened


@pytest.mark.parametrize("capacity, kind", [(2048, "mixed"), (2048, "small"), (100, "mixed"), (7, "mixed"), (1, "small"), (2048, "large")])
def test_plan_is_best_fit_decreasing(capacity, kind):
    rng = random.Random(capacity)
    draw = {"mixed": lambda: min(capacity, int(rng.expovariate(4 / capacity)) + 1), "small": lambda: min(capacity, rng.choice([1, 1, 1, 2, 3])),
            "large": lambda: rng.randint(capacity // 2, capacity)}[kind]
    lengths = [draw() for _ in range(3000)]
    tally = Counter(lengths)
    plan = packing.best_fit(tally, capacity)
    seen, used = Counter(), defaultdict(list)
    for k, (length, first, each, sequence, offset) in enumerate(plan.tolist()):
        end = plan[k + 1][1] if k + 1 < len(plan) and plan[k + 1][0] == length else tally[length]
        assert first == seen[length] and (end - first) % each == 0
        seen[length] = end
        for turn in range(end - first):
            used[sequence + turn // each].append((offset + turn % each * length, length))
    assert seen == tally
    for pieces in used.values():
        pieces.sort()
        assert pieces[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(pieces, pieces[1:])) and sum(pieces[-1]) <= capacity
    assert len(used) == best_fit_decreasing(lengths, capacity) == max(used) + 1


def packed(rows, found, capacity=2048):
    """Checks places and contents; returns the number of sequences."""
    tokenizer = Tokenizer.from_file(vocabulary("word_bpe_49k.json"))
    want = []
    for doc_id, text, *_ in rows:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
        for k in range(0, len(ids), capacity):
            part = np.array(ids[k:k + capacity], "<u4")
            want.append((doc_id, k // capacity, k, len(part), zlib.crc32(part.tobytes())))
    assert sorted((tuple(r[:5]) for r in found), key=str) == sorted(want, key=str)
    by = defaultdict(list)
    for r in found:
        by[r.sequence_id].append((r.offset, r.length))
    for pieces in by.values():
        pieces.sort()
        assert pieces[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(pieces, pieces[1:])) and sum(pieces[-1]) <= capacity
    assert len(by) == best_fit_decreasing([r[3] for r in want], capacity)


def test_packing_of_odd_rows(spark, table, odd):
    rows = [(d, t, "en", "s", 0) for d, t in odd] + [(8, "It's a <|endoftext|>test of Σ'S ΑΣ é ́x İstanbul 123 …", "en", "s", 0), *[(9, "same words", "en", "s", 0)] * 50]
    frame = table(rows)
    assert packing.pack(frame, vocabulary("word_bpe_49k.json")).columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    packed(rows, packing.pack(frame, vocabulary("word_bpe_49k.json")).collect())
    packed(rows, packing.pack(frame, vocabulary("word_bpe_49k.json"), capacity=16).collect(), 16)
    assert packing.pack(table([]), vocabulary("word_bpe_49k.json")).count() == 0


def test_packing_query(spark, folder):
    from shopscope.llm.queries import QUERIES

    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    packed(rows, QUERIES["op12_best_fit_packing"](spark, folder).collect())


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def tree(rows):
    def field(v):
        return "-" if v is None else f"{len(str(v).encode())}:{v}"

    by = defaultdict(list)
    for doc_id, text, lang, source, n in rows:
        leaf = bent = sha(*map(field, (doc_id, source, lang, n, text)))
        if text and doc_id is not None and zlib.crc32(str(doc_id).encode()) % 3 == 0:
            bent = sha(*map(field, (doc_id, source, lang, n, text.translate(LOW))))
        by[lang].append(((doc_id is not None, doc_id or 0), leaf, {"id": doc_id, "leaf": leaf, "bent": bent, "path": []}))

    def climb(nodes):
        """Nodes are (digest, leaves below)."""
        while len(nodes) > 1:
            above = []
            for k in range(0, len(nodes), 8):
                run = [h for h, _ in nodes[k:k + 8]]
                for p in range(len(run)):
                    for leaf in nodes[k + p][1]:
                        leaf["path"].append(("".join(run[:p]), "".join(run[p + 1:])))
                above.append((sha(*run), [x for _, below in nodes[k:k + 8] for x in below]))
            nodes = above
        return nodes[0]

    tops = []
    for lang in sorted(by, key=lambda name: (name is not None, (name or "").encode())):
        tops.append(climb([(h, [x]) for _, h, x in sorted(by[lang], key=lambda r: r[:2])]))
        for x in tops[-1][1]:
            x["sub"] = tops[-1][0]
    out = []
    if tops:
        root, found = climb(tops)
        for x in found:
            folded = x["bent"]
            for a, b in x["path"]:
                folded = sha(a, folded, b)
            out.append((x["id"], x["leaf"], x["sub"], root, sha(*(a + b for a, b in x["path"])), folded, folded == root))
    return sorted(out, key=str)


def same(rows, found):
    return sorted((tuple(r) for r in found.collect()), key=str) == tree(rows)


def test_manifest_of_odd_rows(spark, table, odd):
    rows = [(d, t, "en", "s", 1) for d, t in odd]
    rows += [(None, "A b", "en", "s", 1), (None, "c D", None, None, None), (None, "A b", "en", "s", 1)]
    rows += [(5, f"Text {k % 4}", "en", "s", 3) for k in range(40)]
    rows += [(k**3 * 1000003 - 10**12, "x" * k, "fr" if k % 2 else "", None, k) for k in range(100)]
    rows += [(-2**63, "Min", "de", None, 1), (2**63 - 1, "Max", "de", None, 1)]
    assert same(rows, manifest.manifest(table(rows)))
    assert same(rows[:1], manifest.manifest(table(rows[:1])))
    assert manifest.manifest(table([])).count() == 0


def test_manifest_of_many_languages_and_copies(spark, table):
    rows = [(k, "Copy", f"l{k % 70}", "s", 1) for k in range(200)] + [(7, "Hot", "l0", "s", 1)] * 5000
    assert same(rows, manifest.manifest(table(rows)))


def test_ranks_by_bitmap(spark):
    rng = random.Random(3)
    keys = sorted({rng.choice([rng.randrange(100), rng.randrange(1 << 20), rng.randrange(-2**63, 2**63)]) for _ in range(2000)})
    rows = [("g", k, rng.choice([1, 1, 1, 5])) for k in keys]
    found = {r.key: r["rank"] for r in manifest.ranks(spark.createDataFrame([*rows, ("g", None, 3), ("h", 5, 2)], "grp string, key long, n long").repartition(3)).filter("grp = 'g'").collect()}
    want, total = {None: 0}, 3
    for _, k, n in rows:
        want[k] = total
        total += n
    assert found == want


def test_a_changed_byte_is_found(spark, table):
    rows = [(k, f"Text {k}", "en", "s", k) for k in range(30)]
    before = {r.doc_id: r for r in manifest.manifest(table(rows)).collect()}
    rows[11] = (11, "Text 11!", "en", "s", 11)
    after = {r.doc_id: r for r in manifest.manifest(table(rows)).collect()}
    assert before[11].root != after[11].root and before[11].proof_sha256 == after[11].proof_sha256
    assert {k for k in before if before[k].leaf != after[k].leaf} == {11}
    assert all(r.verified == (zlib.crc32(str(k).encode()) % 3 != 0) for k, r in before.items())
