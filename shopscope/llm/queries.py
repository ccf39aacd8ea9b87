"""One query per operator over the test tables, and its SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopscope.llm import (
    decontaminate, divergence, exact, langmodel, licences, manifest, mixing, neardup, packing, piececount, tokenfiles, toxicity, urls)
from shopscope.llm.tables import table, vocabulary


def op1_wavelet_tokens(spark: SparkSession, folder: str) -> DataFrame:
    return tokenfiles.encode(table(spark, folder, "documents"), vocabulary("byte_bpe_50k.json"))


def op3_maxent_scores(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    model, counts, n, v = langmodel.train(docs.filter(~langmodel.held_out()))
    return langmodel.score(docs, model, counts, n, v).withColumn("held_out", langmodel.held_out())


def op2_dice_licences(spark: SparkSession, folder: str) -> DataFrame:
    return licences.scan_public(table(spark, folder, "documents"))


def op4_subword_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    scored = toxicity.score(docs, toxicity.fit_on(docs, table(spark, folder, "labels")))
    return scored.select(
        "doc_id", toxicity.held_out().alias("held_out"), "score", (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"))


def op5_piece_counts(spark: SparkSession, folder: str) -> DataFrame:
    return piececount.count_pieces(table(spark, folder, "documents"), vocabulary("byte_bpe_50k.json"))


def op6_template_leaks(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op8_entropy_mix(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix(table(spark, folder, "documents")).select(
        "doc_id", "size", "source", "source_size", "target", "rate", "copies", "taken")


def op9_hyperminhash(spark: SparkSession, folder: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, folder, "documents")).select("doc_id", "n_shingles", "component_id", "kept")


URL_RULES = [("org/", "allow"), ("example.org/es/", "block"), ("example.org/en/1", "block"), ("com/fr/", "allow"), ("com/de/", "block")]


def op10_digest_urls(spark: SparkSession, folder: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "rule string, verdict string")
    return urls.judge(table(spark, folder, "pages"), rules)


def op7_chunk_recipes(spark: SparkSession, folder: str) -> DataFrame:
    return exact.duplicates(table(spark, folder, "documents")).drop("recipe")


def op11_iceberg_divergence(spark: SparkSession, folder: str) -> DataFrame:
    return divergence.audit(table(spark, folder, "documents"))


def op12_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(table(spark, folder, "documents"), vocabulary("word_bpe_49k.json"))


def op13_bitmap_manifest(spark: SparkSession, folder: str) -> DataFrame:
    return manifest.manifest(table(spark, folder, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_wavelet_tokens, op2_dice_licences, op3_maxent_scores, op4_subword_toxicity, op5_piece_counts, op6_template_leaks, op7_chunk_recipes,
        op8_entropy_mix, op9_hyperminhash, op10_digest_urls, op11_iceberg_divergence, op12_best_fit_packing, op13_bitmap_manifest)
}
QUERIES["pipeline"] = corpus_pipeline.run

ORACLE_SQL: dict[str, str] = {
    "op7_chunk_recipes": """
        SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
               doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
        FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))""",
    "op10_digest_urls": r"""
        WITH rules(host_of, path_of, says) AS (VALUES
            ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'),
            ('com', '/fr/', 'allow'), ('com', '/de/', 'block')),
        rest AS (SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS r FROM pages),
        split AS (SELECT page_id, regexp_extract(r, '^[^/?#]*') AS h, r FROM rest),
        urls AS (SELECT row_number() OVER () AS n, page_id, translate(h, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                        regexp_extract(substr(r, length(h) + 1), '^[^?#]*') AS path FROM split),
        best AS (SELECT n, arg_max(host_of || path_of, length(host_of || path_of)) AS rule,
                        arg_max(says, length(host_of || path_of)) AS verdict
                 FROM urls JOIN rules ON (host = host_of OR host LIKE '%.' || host_of) AND starts_with(path, path_of) GROUP BY n)
        SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM urls LEFT JOIN best USING (n)""",
    "op11_iceberg_divergence": r"""
        WITH docs AS MATERIALIZED (SELECT row_number() OVER () AS r, coalesce(text, '') AS text, coalesce(lang, '') AS lang, coalesce(source, '') AS source FROM documents),
        words AS MATERIALIZED (SELECT r, lang, source, unnest(regexp_extract_all(
            translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM docs),
        kept AS (SELECT lang, term FROM words GROUP BY ALL HAVING count(DISTINCT r) >= 3),
        sizes AS (SELECT lang, count(*) AS v FROM kept GROUP BY ALL),
        groups AS (SELECT DISTINCT lang, source FROM docs),
        counted AS (SELECT lang, source, term, count(*) AS n FROM words SEMI JOIN kept USING (lang, term) GROUP BY ALL),
        cells AS (SELECT lang, source, term, coalesce(n, 0) AS n FROM groups JOIN kept USING (lang) LEFT JOIN counted USING (lang, source, term)),
        shares AS MATERIALIZED (SELECT lang, source, term, n, 1 + (1000000000::HUGEINT * (n + 1)) // (sum(n) OVER (PARTITION BY lang, source) + v)::HUGEINT AS p
                                FROM cells JOIN sizes USING (lang)),
        whole AS (SELECT lang, term, 1 + (1000000000::HUGEINT * (n + 1)) // (sum(n) OVER (PARTITION BY lang) + v)::HUGEINT AS q
                  FROM (SELECT lang, term, sum(n) AS n FROM counted GROUP BY ALL) JOIN sizes USING (lang)),
        pairs AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
                  FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source != b.source GROUP BY ALL),
        listed AS (SELECT a.lang, a.source, b.source AS item, coalesce(value, 0)::BIGINT AS value
                   FROM groups a JOIN groups b ON a.lang = b.lang AND a.source != b.source
                   LEFT JOIN pairs p ON p.lang = a.lang AND p.source = a.source AND p.item = b.source),
        telling AS (SELECT lang, source, term AS item, ((p - q) * (p - q) // q)::BIGINT AS value FROM shares JOIN whole USING (lang, term) WHERE n > 0 AND p > q)
        SELECT lang, source, 'pair' AS part, item, value, (row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item))::INT AS rank FROM listed
        UNION ALL
        SELECT lang, source, 'term', item, value, (row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item))::INT AS rank FROM telling QUALIFY rank <= 200""",
    "op13_bitmap_manifest": """
        WITH RECURSIVE fields AS (SELECT doc_id, lang, text,
                concat(CASE WHEN doc_id IS NULL THEN '-' ELSE concat(strlen(doc_id::VARCHAR), ':', doc_id) END,
                       CASE WHEN source IS NULL THEN '-' ELSE concat(strlen(source), ':', source) END,
                       CASE WHEN lang IS NULL THEN '-' ELSE concat(strlen(lang), ':', lang) END,
                       CASE WHEN n_chars IS NULL THEN '-' ELSE concat(strlen(n_chars::VARCHAR), ':', n_chars) END) AS head,
                xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
                    lambda crc, b: list_reduce(list_prepend(xor(crc, b), range(8)), lambda x, i: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)),
                    4294967295) AS crc FROM documents),
        hashed AS (SELECT doc_id, lang, sha256(concat(head, CASE WHEN text IS NULL THEN '-' ELSE concat(strlen(text), ':', text) END)) AS leaf,
                CASE WHEN crc % 3 = 0 THEN sha256(concat(head, CASE WHEN text IS NULL THEN '-' ELSE
                    concat(strlen(text), ':', translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) END)) END AS changed FROM fields),
        leaves AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, lang, leaf, coalesce(changed, leaf) AS bent, row_number() OVER same - 1 AS pos, count(*) OVER (PARTITION BY lang) AS size
                FROM hashed WINDOW same AS (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf)),
        lower_tree(k, lang, pos, hash, size) AS (
            SELECT 0, lang, pos, leaf, size FROM leaves
            UNION ALL
            SELECT k + 1, lang, pos // 8, sha256(string_agg(hash, '' ORDER BY pos)), (max(size) + 7) // 8 FROM lower_tree WHERE size > 1 GROUP BY k, lang, pos // 8),
        subroots AS (SELECT lang, hash AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS pos, count(*) OVER () AS size FROM lower_tree WHERE size = 1),
        upper_tree(k, pos, hash, size) AS (
            SELECT 0, pos, subroot, size FROM subroots
            UNION ALL
            SELECT k + 1, pos // 8, sha256(string_agg(hash, '' ORDER BY pos)), (max(size) + 7) // 8 FROM upper_tree WHERE size > 1 GROUP BY k, pos // 8),
        beside AS (
            SELECT r, t.k, t.pos, l.pos // (8 ** t.k)::BIGINT AS own, t.hash FROM leaves l JOIN lower_tree t
            ON t.lang IS NOT DISTINCT FROM l.lang AND t.size > 1 AND t.pos // 8 = l.pos // (8 ** (t.k + 1))::BIGINT
            UNION ALL
            SELECT r, 100 + t.k, t.pos, s.pos // (8 ** t.k)::BIGINT, t.hash FROM leaves l JOIN subroots s ON s.lang IS NOT DISTINCT FROM l.lang JOIN upper_tree t
            ON t.size > 1 AND t.pos // 8 = s.pos // (8 ** (t.k + 1))::BIGINT),
        steps AS (SELECT r, k, coalesce(string_agg(hash, '' ORDER BY pos) FILTER (pos < own), '') AS lefts, coalesce(string_agg(hash, '' ORDER BY pos) FILTER (pos > own), '') AS rights
                  FROM beside GROUP BY r, k),
        paths AS (SELECT r, list(concat(lefts, '|', rights) ORDER BY k) AS path, string_agg(concat(lefts, rights), '' ORDER BY k) AS siblings FROM steps GROUP BY r),
        climbed AS (SELECT doc_id, lang, leaf, sha256(coalesce(siblings, '')) AS proof_sha256, list_reduce(list_prepend(bent, coalesce(path, [])),
                        lambda h, s: sha256(concat(split_part(s, '|', 1), h, split_part(s, '|', 2)))) AS folded_root FROM leaves LEFT JOIN paths USING (r))
        SELECT doc_id, leaf, subroot, root, proof_sha256, folded_root, folded_root = root AS verified
        FROM climbed c JOIN subroots s ON s.lang IS NOT DISTINCT FROM c.lang, (SELECT hash AS root FROM upper_tree WHERE size = 1)""",
}
