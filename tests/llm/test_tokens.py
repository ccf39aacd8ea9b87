"""Token files, piece counts and the language model against definitions."""

import collections
import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from shopscope.llm import langmodel, piececount, text, tokenfiles
from shopscope.llm.tables import vocabulary

BPE = vocabulary("byte_bpe_50k.json")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {k: k + 32 for k in range(65, 91)}


def test_shard_answers(spark):
    rng = np.random.default_rng(1)
    ids = rng.choice([3, 17, 50256, 999, 2, 40000], 100_000, p=[0.5, 0.2, 0.1, 0.1, 0.05, 0.05]).astype(np.uint32)
    shard = tokenfiles.Shard(tokenfiles.pack(ids, [1, None], np.array([60_000, 40_000])))
    assert (shard.ids() == ids).all() and shard.doc_ids == [1, None]
    for i in (0, 1, 32767, 32768, 65535, 99_999):
        assert shard.token(i) == ids[i]
    for token in (3, 50256, 2, 5):
        places = np.flatnonzero(ids == token)
        assert shard.count(token) == len(places)
        assert shard.count(token, 70_000) == (places < 70_000).sum()
        for k in (0, len(places) // 2, len(places) - 1) if len(places) else ():
            assert shard.find(token, k) == places[k]
    with pytest.raises(IndexError):
        shard.find(5, 0)
    assert len(tokenfiles.pack(ids, [1], np.array([len(ids)]))) < 4 * len(ids) / 4


@pytest.mark.parametrize("ids", [[], [7], [7, 7, 7], [0, 4_000_000_000 % 2**22 + 2**22]])
def test_small_shards(ids):
    ids = np.array(ids, np.uint32)
    shard = tokenfiles.Shard(tokenfiles.pack(ids, [9], np.array([len(ids)])))
    assert shard.ids().tolist() == ids.tolist() == [shard.token(i) for i in range(len(ids))]


TRICKY = [
    "don 't it's  two  blanks\n\nnew\nline \n end ", " lead", "tail ", "  gap  x", "a 　 b", "é é à la été, où", "1 22 333 a1 b2\tc",
    "<|endoftext|> inside <|end oftext|> a<|endoftext|>b", "x" * 3000, "日本語 テキスト と english", "!! ?? . , ' 's 're", "\r\n a\r\nb", "🙂 🙂🙂 a🙂 b", " ", "\n",
]


def test_ids_are_the_libraries_own(spark, texts, odd):
    rng = random.Random(2)
    pool = "ab zé\n \t.'1s🙂 "
    rows = [(100 + k, t) for k, t in enumerate(TRICKY)] + [(1000 + k, "".join(rng.choices(pool, k=60))) for k in range(300)] + odd
    tokenizer = Tokenizer.from_file(BPE)
    got = tokenfiles.encode(texts(rows), BPE, shard_tokens=5000).collect()
    want, start = [], 0
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [2]
        want.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert sorted(((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in got), key=lambda r: r[1]) == want
    assert len({(r.part, r.shard) for r in got}) > 2


def test_known_words_are_merged_once():
    column = pa.array(["house tree été house", None, " tree garden", "été\nhouse"])
    known = tokenfiles.Known()
    ids, counts = tokenfiles.Encoder(BPE, known).encode(column)
    want = [Tokenizer.from_file(BPE).encode(t or "", add_special_tokens=False).ids for t in column.to_pylist()]
    assert ids.tolist() == sum(want, []) and counts.tolist() == [len(w) for w in want]
    later = tokenfiles.Encoder(BPE, known)
    whole, merged = later.tokenizer, []

    class Watched:
        encode_batch_fast = whole.encode_batch_fast

        class model:  # noqa: N801
            @staticmethod
            def tokenize(word):
                merged.append(word)
                return whole.model.tokenize(word)

    later.tokenizer = Watched
    again, _ = later.encode(column)
    assert again.tolist() == ids.tolist() and merged == []
    more, _ = later.encode(pa.array(["house newly tree"]))
    assert more.tolist() == whole.encode("house newly tree", add_special_tokens=False).ids and len(merged) == 1


def test_words_of_one_hash_are_told_apart():
    known = tokenfiles.Known()
    buf = np.frombuffer(b"oneTWOsixlonger", np.uint8)
    of = lambda *x: np.array(x)
    known.add(of(5, 9).astype(np.uint64), buf, of(0, 3), of(3, 3), np.array([7, 8, 9], np.uint32), of(1, 2))
    # The same words, others with their hashes, one of another length, one with a hash that is not there.
    assert known.find(of(5, 9, 5, 9, 9, 10).astype(np.uint64), buf, of(0, 3, 3, 6, 9, 6), of(3, 3, 3, 3, 6, 3)).tolist() == [0, 1, -1, -1, -1, -1]
    known.add(of(3, 5).astype(np.uint64), buf, of(9, 6), of(6, 3), np.array([1, 2], np.uint32), of(1, 1))
    assert known.hashes.tolist() == [3, 5, 9] and known.find(of(3, 5, 9).astype(np.uint64), buf, of(9, 6, 3), of(6, 3, 3)).tolist() == [2, -1, 1]
    ids = [known.ids[a:a + n].tolist() for a, n in zip(known.id_starts, known.counts)]
    assert ids == [[7], [8, 9], [1]]


def test_known_words_go_when_other_tasks_come():
    text.kept("words", list).append(1)
    batch = pa.record_batch([pa.array(["a"])], ["text"])
    assert len(list(text.slices(iter([batch]), keep="words"))) == 1 and text.kept("words", list) == [1]
    assert len(list(text.slices(iter([batch])))) == 1 and text.kept("words", list) == []
    list(text.slices(iter([])))


def test_token_files_of_nothing(texts):
    assert tokenfiles.encode(texts([]), BPE).count() == 0


def test_automaton_is_greedy():
    rng = random.Random(3)
    pieces = {bytes([b]) for b in range(256)} | {bytes(rng.choices(b" abc", k=rng.randint(2, 7))) for _ in range(300)}
    machine = piececount.Automaton(list(pieces))
    words = [bytes(rng.choices(b"abcd", k=rng.randint(1, 40))) for _ in range(2000)]
    buf = np.frombuffer(b"".join(words), np.uint8)
    ends = np.cumsum([len(w) for w in words])
    starts = ends - [len(w) for w in words]
    assert machine.count(buf, starts, ends).tolist() == [len(piececount.greedy_pieces(b" " + w, pieces)) for w in words]
    with pytest.raises(ValueError):
        piececount.Automaton([b"a"])


def test_piece_counts(texts, odd):
    rows = odd + [(20, "The quick brown fox jumps over unbelievable pneumonoultramicroscopics"), (21, TRICKY[0])]
    pieces = set(piececount.byte_pieces(BPE))
    want = []
    for doc_id, text in rows:
        words = WORD.findall(text or "")
        counted = {w: len(piececount.greedy_pieces(b" " + w.encode(), pieces)) if len(w) < 5000 else None for w in set(words)}
        if None not in counted.values():
            want.append((doc_id, len(words), sum(counted[w] for w in words)))
    got = [(r.doc_id, r.n_words, r.n_pieces) for r in piececount.count_pieces(texts(rows), BPE).collect()]
    assert not collections.Counter(want) - collections.Counter(got) and len(got) == len(rows)
    assert piececount.count_pieces(texts([]), BPE).count() == 0


def sample(n, seed=1):
    """Texts of two languages in which a word tells much about the next."""
    rng = random.Random(seed)
    rows = []
    for k in range(n):
        tongue = rng.choice("ab")
        words = []
        for _ in range(rng.randint(5, 60)):
            words.append(f"{tongue}{rng.randint(0, 30)}end{tongue}" if rng.random() < 0.9 else f"rare{rng.randint(0, 10**6)}")
        rows.append((k, " ".join(words)))
    return rows


def test_base_score_and_counts(texts, odd):
    rows = sample(200) + [(1000 + (i or 0), t) for i, t in odd]
    docs = texts(rows)
    model, counts, n, v = langmodel.train(docs.filter(~langmodel.held_out()))
    held = lambda i: zlib.crc32(str(i).encode()) % 7 == 2
    tokens = {k: [*WORD.findall((t or "").translate(LOWER)), None] for k, (_, t) in enumerate(rows)}
    c = collections.Counter(w for k, (i, _) in enumerate(rows) if not held(i) for w in tokens[k])
    assert (n, v) == (sum(c.values()), len(c))
    got = collections.Counter((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in langmodel.score(docs, model, counts, n, v).collect())
    want = collections.Counter(
        (i, len(tokens[k]), sum(w in c for w in tokens[k]), n, round(sum(math.log10((c[w] + 1) / (n + v + 1)) for w in tokens[k]), 6)) for k, (i, _) in enumerate(rows))
    assert got == want


def test_context_helps_held_out_texts(texts):
    docs = texts(sample(1500))
    model, counts, n, v = langmodel.train(docs.filter(~langmodel.held_out()))
    rows = langmodel.score(docs, model, counts, n, v).filter(langmodel.held_out()).collect()
    assert sum(r.score for r in rows) > 0.93 * sum(r.base_score for r in rows)


def test_runs_are_added_in_pairs_as_they_are_gathered():
    rng = np.random.default_rng(4)
    values = rng.random((300, 4), dtype=np.float32)
    lengths = np.array([1, 2, 3, 1, 4, 5, 8, 13, 64, 199])
    order, starts = rng.integers(0, 300, lengths.sum()), np.cumsum(lengths) - lengths

    def pairs(rows):
        while len(rows) > 1:
            rows = [rows[k] + rows[k + 1] if k + 1 < len(rows) else rows[k] for k in range(0, len(rows), 2)]
        return rows[0]

    before = values.copy()
    want = [pairs([values[k] for k in order[a:a + n]]) for a, n in zip(starts, lengths)]
    assert (langmodel._run_sums(values, order, starts) == np.array(want)).all() and (values == before).all()


def test_picked_logs_are_those_of_the_whole_rows():
    rng = np.random.default_rng(5)
    kinds = langmodel.CLASSES
    head, counts = np.arange(1, 101, dtype=np.uint64), rng.integers(1, 50, 100)
    model = langmodel.Model(head, counts, np.arange(100) % kinds, np.full(kinds, 200.0), np.full(kinds, 5.0))
    model.weights[:] = rng.normal(0, 3, model.weights.shape)
    rows = [rng.integers(0, langmodel.ROWS, 77) for _ in range(4)]
    classes, slots = rng.integers(0, kinds, 77), np.where(rng.random(77) < 0.5, 0, langmodel.SLOTS - 1)
    a, b, _, _ = model.logs(rows, classes)
    own_a, own_b = model.picked(rows, classes, slots)
    at = np.arange(77)
    assert (own_a == a[at, classes]).all() and (own_b == b[at, slots]).all()


def test_probabilities_add_up(texts):
    import pyarrow as pa

    docs = texts(sample(50))
    model, counts, n, v = langmodel.train(docs)
    known = counts.collect()
    tokens = langmodel.Tokens(pa.array(["a1enda a2enda"]))
    rows = [r[1:2] for r in tokens.features()]
    total = 0.0
    per_class = collections.Counter(r["class"] for r in known)
    at = model.lookup.find(np.array([r.token for r in known], np.int64).view(np.uint64))
    for kind in range(langmodel.CLASSES):
        log_a, log_b, _, _ = model.logs(rows, np.array([kind]))
        inside = 0.0
        for r, k in zip(known, at):
            if r["class"] == kind:
                slot = model.slot[k]
                inside += np.exp(log_b[0, slot]) * (1 if slot < langmodel.SLOTS - 1 else (r.n + 1) / 10 ** model.rest[kind])
        inside += np.exp(log_b[0, -1]) / 10 ** model.rest[kind]
        assert per_class[kind] == 0 or inside == pytest.approx(1, abs=1e-4)
        total += np.exp(log_a[0, kind]) * inside
    assert total == pytest.approx(1, abs=1e-3)


def test_language_model_of_nothing(texts):
    model, counts, n, v = langmodel.train(texts([]))
    assert (n, v) == (0, 0)
    rows = langmodel.score(texts([(1, "a b"), (2, None)]), model, counts, n, v).collect()
    assert {(r.doc_id, r.n_tokens, r.n_known, r.base_score) for r in rows} == {(1, 3, 0, 0.0), (2, 1, 0, 0.0)}
    assert langmodel.score(texts([]), model, counts, n, v).count() == 0


def test_lookup():
    rng = np.random.default_rng(1)
    keys = rng.integers(0, 2**63, 5000, dtype=np.uint64)
    keys[:200] = np.arange(200, dtype=np.uint64)  # all in one neighbourhood
    table = langmodel.Lookup(keys)
    assert (table.find(keys) == np.arange(5000)).all()
    assert (table.find(keys[200:] ^ np.uint64(1 << 62)) == -1).all()


def test_cuts_around_latin_letters_and_line_breaks_keep_the_librarys_ids():
    encoder = tokenfiles.Encoder(BPE)
    texts = ["é\n\nFoo", "\nFoo", "a\n", "\n", "", None, "été×2 ÷é", "don't été's l'été\nécole  Ça va Ƀa ɐa", "été\tx\nÀ",
             "  \nfoo \n bar\n \nbaz", "日本 é 語 a　é\nb", "x \ny é", " é", "é ", "ȿ ȿ\nȿ", "a é\u0085b é2 é-é"]
    ids, counts = encoder.encode(pa.array(texts, pa.string()))
    found = [part.tolist() for part in np.split(ids, np.cumsum(counts)[:-1])]
    assert found == [encoder.tokenizer.encode(text or "", add_special_tokens=False).ids for text in texts]


def test_hashes_do_not_depend_on_blocks(monkeypatch):
    from shopscope.llm import text

    rng = np.random.default_rng(8)
    buf = rng.integers(0, 256, 5000).astype(np.uint8)
    starts = rng.integers(0, 4900, 400)
    ends = np.minimum(starts + rng.integers(0, 90, 400), 5000)
    ends[7] = 5000
    whole = text.span_hashes(buf, starts, ends)
    for block in (64, 1000, 4999):
        monkeypatch.setattr(text, "SLICE_BYTES", block)
        assert (text.span_hashes(buf, starts, ends) == whole).all()
    assert len(text.span_hashes(buf, starts[:0], ends[:0])) == 0
