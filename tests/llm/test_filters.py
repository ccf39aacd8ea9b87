"""Toxicity, licences, decontamination, URL rules and mixing against definitions."""

import random
import re

import pytest
from pyspark.sql import functions as F

from shopscope.llm import decontaminate, licences, mixing, toxicity, urls

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def prose(rng, n):
    return " ".join("".join(rng.choices("abcdefghijklmno", k=rng.randint(2, 8))) for _ in range(n))


def test_toxic_words_are_learned_with_misspellings(spark, texts):
    rng = random.Random(1)
    rows, labels = [], []
    for k in range(500):
        words = prose(rng, rng.choice([8, 40, 400])).split()
        bad = k % 5 == 0
        if bad:
            for _ in range(2):
                words.insert(rng.randrange(len(words)), rng.choice(["wretchedzz", "zzvillain", "qqscoundrel"]))
        rows.append((k, " ".join(words)))
        labels.append((k, 1, int(bad)))
    rows += [(1000, "abc def wretchdzz ghi"), (1001, "abc def ghi"), (1002, None), (1003, "")]
    docs = texts(rows)
    model = toxicity.fit_on(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    got = {r.doc_id: r.score for r in toxicity.score(docs, model).collect()}
    assert len(got) == len(rows) and all(0 <= s <= 1 for s in got.values())
    wrong = sum((got[k] >= 0.3) != bool(t) for k, _, t in labels)
    assert wrong <= 25
    assert got[1000] > got[1001] and got[1002] == got[1003] < 0.3
    kept = toxicity.without_toxic(docs, model)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {k for k, s in got.items() if s < 0.3}


@pytest.mark.parametrize(("labels", "want"), [([], 0.0), ([(1, 0, 0), (None, 0, 1)], 0.0), ([(1, 0, 1), (3, 0, 1)], 1.0)])
def test_toxicity_without_both_labels(spark, texts, odd, labels, want):
    docs = texts(odd)
    model = toxicity.fit(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    assert {r.score for r in toxicity.score(docs, model).collect()} == {want}
    assert toxicity.score(texts([]), model).count() == 0


def known_runs(text, templates):
    """Longest runs of words whose neighbours are all bigrams of templates."""
    known = set().union(*map(licences.bigrams_of, templates.values()))
    words = re.findall("[a-z0-9]+", text.translate({k: k + 32 for k in range(65, 91)}))
    out = [[]]
    for a, b in zip(words, words[1:]):
        if f"{a} {b}" in known:
            out[-1] = [*(out[-1] or [a]), b]
        elif out[-1]:
            out.append([])
    return {" ".join(run) for run in out if run}


def brute_licences(rows, templates, least):
    best = {}
    for doc_id, text in rows:
        for passage in {*known_runs(text or "", templates), *(text or "").split("\n"), *re.split(r"\n[ \t\r]*\n", text or ""), text or ""}:
            own = licences.bigrams_of(passage)
            for name, template in templates.items():
                other = licences.bigrams_of(template)
                if own and 2 * len(own & other) / (len(own) + len(other)) >= least:
                    best[doc_id, name] = max(best.get((doc_id, name), 0), 2 * len(own & other) / (len(own) + len(other)))
    return sorted((str(d), n, round(s, 9)) for (d, n), s in best.items())


@pytest.mark.parametrize("least", [0.8, 0.5])
def test_licences_match_brute_force(texts, odd, least):
    rng = random.Random(2)
    rows = list(odd)
    for k, (_, template) in enumerate(sorted(licences.TEMPLATES.items()) * 3):
        words = template.split()
        for _ in range(rng.randint(0, 4)):
            words[rng.randrange(len(words))] = "changed"
        shape = rng.choice(["{0}", "some text\n{0}\nmore text", "before\n\n{0}\n \nafter", "{0} and a long tail " + prose(rng, 30)])
        rows.append((100 + k, shape.format("\n".join([" ".join(words[:9]), " ".join(words[9:])]) if k % 2 else " ".join(words))))
    rows.append((rows[-1][0], rows[-1][1]))
    got = licences.scan(texts(rows), least=least).collect()
    assert sorted((str(r.doc_id), r.licence, round(r.dice, 9)) for r in got) == brute_licences(rows, licences.TEMPLATES, least)


def test_notices_inside_lines(texts):
    grant = licences.TEMPLATES["BSD-redistribution"].split()
    lines = {
        1: ("Some words of ours. Copyright 2020 Foo Inc. All rights reserved. Read the terms before you go on", "all-rights-reserved", "all rights reserved"),
        2: ("This tool, long in the making, is released under the MIT License. It reads tables and writes them", "MIT-notice", "released under the mit license"),
        3: ("(c) 2020 Foo. All rights reserved. Terms | Privacy", "all-rights-reserved", "all rights reserved"),
        4: (f"/* {prose(random.Random(5), 40)}\n * {' '.join(grant[:9])}\n * {' '.join(grant[9:])}\n * x", "BSD-redistribution", None),
        5: (f"{prose(random.Random(6), 200000)} Released under the MIT License {prose(random.Random(7), 10)}", "MIT-notice", "released under the mit license"),
    }
    rows = [(k, line) for k, (line, _, _) in lines.items()]
    found = {r.doc_id: r for r in licences.scan(texts(rows + rows[:2])).collect()}
    assert set(found) == set(lines)
    for k, (_, licence, passage) in lines.items():
        assert found[k].licence == licence and found[k].dice >= 0.8
        assert passage in (None, found[k].passage)
    assert licences.scan(texts(rows), inside=False).count() == 0


def test_licences_of_nothing(texts):
    assert licences.scan(texts([])).count() == 0
    assert licences.scan(texts([(1, "a b c")]), templates={"x": "one"}).count() == 0


def test_licence_plan_has_no_python(spark, texts):
    docs = texts([(1, "a")])
    sets = {name: licences.bigrams_of(text) for name, text in licences.TEMPLATES.items()}
    for part in (licences.candidates(docs, sets, 4, 5, True), licences.scan(docs)):
        assert not re.search("Python|Pandas|Arrow|Cartesian", part._jdf.queryExecution().toString())


BENCH = [
    (1, "If a train leaves Boston at 5 with 60 km per hour and another leaves at 5 with 80 km per hour when do the two trains meet"),
    (2, "the quick question about green apples and seven hungry farmers who share every basket evenly among their neighbours"),
    (3, None), (4, ""), (5, "tiny item here"),
]


def leaks(texts, spark, rows, **settings):
    bench = spark.createDataFrame(BENCH, "item_id long, text string")
    return sorted((r.doc_id, r.item_id) for r in decontaminate.contaminated(texts(rows), bench, **settings).collect())


def test_contaminated_documents(texts, spark, odd):
    rng = random.Random(3)
    item, other = BENCH[0][1], BENCH[1][1]
    rows = [
        (10, f"{prose(rng, 300)}. {item}. {prose(rng, 300)}"),
        (11, item.replace("5", "7").replace("60", "61").replace("Boston", "Denver")),  # re-parameterised
        (12, item.replace("at 5 with 80", "at 9 with 80").replace("60 km", "80 km").replace("5", "80")),
        (13, " ".join(other.split()[:8])),  # a part only
        (14, f"{prose(rng, 20)} {other.upper()} {prose(rng, 20)}"),
        (15, prose(rng, 500)),
        (16, f"{other}\n{item}"),
        (17, "is there a Tiny item here?"),
        (18, " ".join(f"{a} {prose(rng, 60)}" for a in re.findall(r"\S+(?: \S+){4}", other))),  # windows far apart
    ]
    got = leaks(texts, spark, rows + odd)
    assert {(10, 1), (11, 1), (14, 2), (16, 1), (16, 2)} <= set(got)
    assert not {d for d, _ in got} & {13, 15, 18, *(i for i, _ in odd)}
    assert got == leaks(texts, spark, rows + odd, block_windows=10)


def test_inconsistent_slots_are_no_leak(texts, spark):
    words = BENCH[0][1].split()
    mixed = " ".join(str(100 + k) if w.isdigit() else w for k, w in enumerate(words))
    bench = spark.createDataFrame([(1, BENCH[0][1].replace("60", "5").replace("80", "5"))], "item_id long, text string")
    assert decontaminate.contaminated(texts([(1, mixed)]), bench).count() == 0
    assert decontaminate.contaminated(texts([(1, mixed)]), bench, agree=0.0).count() == 1


def test_decontamination_keeps_clean_rows(texts, spark, odd):
    bench = spark.createDataFrame(BENCH, "item_id long, text string")
    docs = texts([*odd, (10, BENCH[1][1])])
    kept = decontaminate.without_contaminated(docs, bench)
    assert kept.columns == docs.columns and kept.count() == len(odd)
    assert decontaminate.contaminated(texts([]), bench).count() == 0
    assert decontaminate.contaminated(docs, bench.limit(0)).count() == 0


RULES = [("org/", "allow"), ("example.org/es/", "block"), ("example.org/en/1", "block"), ("com/fr/", "allow"), ("com/de/", "block"), ("a.b.org/x", "block")]
URLS = [
    None, "", "no scheme/en/1", "https://example.org/es/", "https://WWW.Example.ORG/es/x?q=/en/", "http://example.org/en/12", "http://example.org/en/2",
    "http://notexample.org/es/", "http://x.com/de/1", "http://x.com/DE/1", "http://com/fr/", "ftp://a.b.org/x?y#z", "http://a.b.org", "http://org#frag", "://", "http:///es/",
    "http://a://b.org/x", "http://ex\u00e4mple.org/es/", "http://example.org./es/",
]


def brute_verdict(url, rules):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.match(r"[^/?#]*", rest).group().translate({k: k + 32 for k in range(65, 91)})
    path = re.match(r"[^?#]*", rest[len(host):]).group()
    fits = [(len(r), len(r.split("/")[0]), r, v) for r, v in rules
            if host and (host == r.split("/")[0] or host.endswith("." + r.split("/")[0])) and path.startswith(r[r.index("/"):])]
    best = max(fits, default=None)
    return host, path, best and best[2], best[3] if best else "allow"


@pytest.mark.parametrize("part_bytes", [urls.PART_BYTES, 20])
def test_url_rules(spark, part_bytes):
    pages = spark.createDataFrame([(k, u, "x") for k, u in enumerate(URLS + URLS[:3])], "page_id long, url string, rule string")
    rules = spark.createDataFrame(RULES + RULES[:1], "rule string, verdict string")
    got = sorted(urls.judge(pages, rules, part_bytes=part_bytes).collect())
    assert [tuple(r) for r in got] == [(k, *brute_verdict(u, RULES)) for k, u in enumerate(URLS + URLS[:3])]


def test_long_hosts_cost_what_the_rules_cost(spark, tmp_path):
    """Only suffixes of a rule host's length are looked up, however long the host is and however many dots it has."""
    (tmp_path / "rules").write_bytes(urls.encode(RULES))
    array = urls.DigestArray(str(tmp_path / "rules"))
    host = "a." * 500_000 + "example.org"
    looked_up = []
    array.find = lambda probes: looked_up.append(probes) or urls.DigestArray.find(array, probes)
    found, verdicts = array.best([host, "x" * 1_000_000, "." * 1_000_000], ["/es/1", "/", "/"])
    assert found[1:] == [None, None] and found[0] is not None and verdicts[0] is not None
    assert sum(map(len, looked_up[0])) < 10_000


def test_url_rules_empty(spark):
    pages = spark.createDataFrame([(1, "http://a.org/")], "page_id long, url string")
    rules = spark.createDataFrame(RULES, "rule string, verdict string")
    assert [tuple(r) for r in urls.judge(pages, rules.limit(0)).collect()] == [(1, "a.org", "/", None, "allow")]
    assert urls.judge(pages.limit(0), rules).count() == 0
    with pytest.raises(ValueError):
        urls.encode([("noslash", "allow")])
    with pytest.raises(ValueError):
        urls.encode([("a/", "allow"), ("A/", "block")])


def test_colliding_digests_are_told_apart(tmp_path, monkeypatch):
    monkeypatch.setattr(urls.xxhash, "xxh64_intdigest", lambda text: len(text))
    (tmp_path / "rules").write_bytes(urls.encode(RULES))
    array = urls.DigestArray(str(tmp_path / "rules"))
    for rule, verdict in RULES:
        at = array.find([rule.encode()])[0]
        assert urls.VERDICTS[array.verdicts[at]] == verdict
    assert array.find([b"zzz/", b"com/it/"]).tolist() == [-1, -1]


def brute_targets(sizes, weights=(5, 2, 1), share=1.5, most=2):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode("utf-32-be")) + [None] * (None in sizes)
    weight = {s: weights[k % 3] for k, s in enumerate(names)}
    full, left = set(), share * sum(sizes.values())
    while True:
        open_ = [s for s in names if s not in full]
        total = sum(weight[s] for s in open_)
        target = {s: left * weight[s] / total for s in open_}
        over = [s for s in open_ if target[s] > most * sizes[s]]
        if not over:
            return {**{s: most * sizes[s] for s in full}, **target}
        for s in over:
            full.add(s)
            left -= most * sizes[s]
        if len(full) == len(names):
            return {s: most * sizes[s] for s in full}


def test_mix(texts):
    rng = random.Random(4)
    sources = ["b", "a", "é", None, "Z", "hot"]
    rows = [(k, prose(rng, int(rng.paretovariate(1) * 5)) if rng.random() < 0.95 else rng.choice([None, "", " "]), rng.choice([*sources, "hot", "hot"])) for k in range(1500)]
    rows += rows[:20]
    docs = texts(rows)
    got = mixing.mix(docs, bucket_rows=100).collect()
    assert len(got) == len(rows)
    sizes, taken = {}, {}
    for _, text, source in rows:
        sizes[source] = sizes.get(source, 0) + len(WORD.findall(text or ""))
    want = brute_targets(sizes)
    longest = {}
    for r in got:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source])
        assert r.taken == r.copies * r.size and 0 <= r.copies <= 2 and 0 <= r.rate <= 2
        taken[r.source] = taken.get(r.source, 0) + r.taken
        longest[r.source] = max(longest.get(r.source, 0), r.size)
    for source, target in want.items():
        # Copies are whole: a text that outweighs the rest of its bucket can leave half of itself over.
        assert abs(taken[source] - target) <= max(30, 0.01 * target, longest[source] / 2)
    again = mixing.mix(docs.repartition(7), bucket_rows=100).collect()
    key = lambda rows: sorted((r.doc_id, r.taken) for r in rows)
    assert key(again) == key(got)
    out = mixing.mixed(docs, bucket_rows=100)
    assert out.columns == docs.columns and out.count() == sum(r.copies for r in got)


def test_mix_of_one_source_and_of_nothing(texts, odd):
    got = mixing.mix(texts([(1, "a b c", "x"), (2, "a", "x")])).collect()
    assert {r.target for r in got} == {6.0}
    assert sum(r.taken for r in got) in (6, 8, 7)
    assert mixing.mix(texts(odd)).count() == len(odd)
    assert mixing.mix(texts([])).count() == 0
    assert mixing.mixed(texts([])).count() == 0
    assert mixing.mix(texts([(1, None, None), (2, "", "x")])).filter(F.col("taken") > 0).count() == 0


def test_common_licences_are_found(texts):
    lines = [
        ("This work is licensed under the GNU General Public License, version 3.", "GPL-3"), ("Licensed under CC BY-NC 4.0.", "CC-BY-NC-4.0"),
        ("This work is licensed under the GNU Lesser General Public License, version 2.1.", "LGPL-2.1"), ("Licensed under the AGPLv3.", "AGPL-3"),
        ("Licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License.", "CC-BY-NC-ND-4.0"),
        ("Licensed under CC BY-ND 3.0", "CC-BY-ND-3.0"), ("Released under the BSD 3-Clause License.", "BSD-3-Clause"),
        ("SPDX-License-Identifier: MPL-2.0", "MPL-2.0"), (licences.TEXTS["GPL-3-text"], "GPL-3"), (licences.MORE["MIT-text"], "MIT")]
    found = licences.scan_public(texts([(k, f"some text\n\n{line}\n\nmore text") for k, (line, _) in enumerate(lines)])).collect()
    for k, (line, licence) in enumerate(lines):
        rows = [r for r in found if r.doc_id == k]
        best = max((r.dice for r in rows), default=0)
        assert any(r.licence.startswith(licence) and r.dice == best for r in rows), line[:80]


def test_licences_on_the_bounds_are_found(texts):
    """Passages whose size, overlap or Dice is exactly the least that counts."""
    assert [(r.licence, r.dice) for r in licences.scan(texts([(1, "All rights reserved.")])).collect()] == [("all-rights-reserved", 0.8)]
    for least, n, m in [(0.8, 3, 2), (0.8, 6, 4), (0.8, 9, 6), (0.5, 6, 2), (0.6, 7, 3), (0.9, 11, 9), (0.7, 13, 7)]:
        longer, part = (" ".join(f"w{k}" for k in range(size + 1)) for size in (n, m))
        assert licences.scan(texts([(1, part)], 1), {"longer": longer}, least).count() == 1, (least, n, m)
        assert licences.scan(texts([(1, longer)], 1), {"part": part}, least).count() == 1, (least, n, m)


def test_every_alignment_is_judged(texts, spark):
    items = ["What is 2 plus 3 plus 4 plus 5 plus 6 plus 7", BENCH[0][1], "2 apples 3 apples 4 apples 5 apples 6 apples 7 apples"]
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    rng = random.Random(7)
    docs = [(k, f"{prose(rng, 30)}. {item}. {prose(rng, 30)}") for k, item in enumerate(items)]
    strict = [(1, "If a train leaves Boston at 5 with 60 km per hour and another leaves at 5 with 60 km per hour when do 5 trains meet 5 trains")]
    tangled = strict[0][1].split()
    tangled = " ".join(str(200 + k) if w.isdigit() else w for k, w in enumerate(tangled))
    found = {(r.doc_id, r.item_id, r.slot_agreement) for r in decontaminate.contaminated(texts(docs), bench).collect()}
    assert {(k, k, 1.0) for k in range(len(items))} <= found
    quiz = texts([(1, f"{tangled}. {prose(rng, 40)}. {strict[0][1]}")])
    repeats = spark.createDataFrame(strict, "item_id long, text string")
    assert decontaminate.contaminated(texts([(1, tangled)]), repeats).count() == 0
    assert decontaminate.contaminated(quiz, repeats).count() == 1
    assert decontaminate.without_contaminated(quiz, repeats).count() == 0


def test_copies_in_other_case_and_signs(texts, spark):
    items = [
        "What is the sum of nine", "Who wrote the long red book", "Anna told Bob that the farmer Carl had sold seven hungry goats to Dora. Then Bob asked Anna where Carl went.",
        "The farmer told Bob that seven hungry goats had left the barn before noon and gone to the river with their friends",
    ]
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    shapes = ["1) {}", "- {}", "* {}", '"{}"', "well, {}", "Question 7 {}", "({})", "\u201c{}\u201d", "\u2014{}"]
    rows = [(100 * k + n, shape.format(item)) for k, item in enumerate(items) for n, shape in enumerate(shapes)]
    rows += [(100 * k + 50, item.lower()) for k, item in enumerate(items)] + [(100 * k + 51, item.replace(".", "")) for k, item in enumerate(items)]
    rows.append((352, items[3].replace("Bob", "Mary Ann")))
    rows.append((900, "the farmer asked where the goats of the river were"))
    found = {(r.doc_id, r.item_id) for r in decontaminate.contaminated(texts(rows), bench).collect()}
    assert found == {(d, d // 100) for d, _ in rows if d < 900}
    kept = decontaminate.without_contaminated(texts(rows), bench).collect()
    assert [r.doc_id for r in kept] == [900]
