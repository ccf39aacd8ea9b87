"""Loads: JSON arrays through VARIANT, unique keys, counts per rule, rejects, publishing."""

import json

import pytest
from pyspark.sql import functions as F

from retail_documents import CATEGORIES, PRODUCTS, SESSIONS, TRANSACTIONS, USERS, user, write_documents
from shopscope.operators import cleaning
from shopscope.schemas import ENTITIES
from shopscope.sources import documents, loading


def counts(report):
    found = {}
    for r in report.collect():
        found.setdefault(r.table, {})[r.rule] = r.rows
    return found


@pytest.fixture
def shop(tmp_path):
    (tmp_path / "json").mkdir()
    write_documents(tmp_path / "json")
    return tmp_path


def test_variants_read_what_the_typed_reader_reads(spark, shop):
    for entity in ENTITIES:
        typed = documents.read_documents(spark, str(shop / "json"), entity)
        found = loading.typed_rows(loading.read_variants(spark, str(shop / "json"), entity), entity)
        assert found.filter("_reason IS NOT NULL").isEmpty(), entity
        assert sorted(map(str, found.select(*typed.columns).collect())) == sorted(map(str, typed.collect())), entity


def test_large_files_take_the_typed_reader(spark, shop):
    small = loading.read_variants(spark, str(shop / "json"), "sessions")
    large = loading.read_variants(spark, str(shop / "json"), "sessions", most_bytes=1)
    rows = [sorted(map(str, loading.typed_rows(v, "sessions").drop("_position").collect())) for v in (small, large)]
    assert rows[0] == rows[1] and len(rows[0]) == 7


def test_lines(spark, tmp_path):
    (tmp_path / "users.json").write_text("\n".join([json.dumps(USERS[0]), "{broken", json.dumps(USERS[1])]))
    found = loading.typed_rows(loading.read_variants(spark, str(tmp_path), "users", multiline=False), "users")
    assert sorted((r.user_id or "", r._reason) for r in found.collect()) == [("", "malformed text"), ("u1", None), ("u2", None)]


def test_counts_per_rule_and_published_tables(spark, shop):
    report = counts(loading.load(spark, str(shop / "json"), str(shop / "tables")))
    assert report["users"] | {"rows in": 5, "rows kept": 4, "user_id missing": 1, "registration_date missing": 0, "unreadable": 0} == report["users"]
    assert report["transactions"] | {"rows in": 6, "rows kept": 5, "total not positive": 1, "total missing": 0} == report["transactions"]
    assert report["sessions"] | {"rows in": 7, "rows kept": 6, "duration not positive": 1} == report["sessions"]
    assert report["categories"] | {"rows in": len(CATEGORIES), "rows kept": len(CATEGORIES), "category_id repeated": 0} == report["categories"]
    assert report["products"]["rows kept"] == len(PRODUCTS)
    shelf = documents.Store(spark, str(shop / "tables"))
    for entity in ("users", "products", "transactions", "sessions"):
        assert getattr(shelf, entity).count() == report[entity]["rows kept"], entity
    assert shelf.raw("transactions").count() == len(TRANSACTIONS) and shelf.raw("sessions").count() == sum(map(len, SESSIONS))


def test_rules_are_those_of_the_cleaning_step(spark):
    odd = [("t1", "u", "2025-01-01T00:00:00", 1.0), (None, "u", "2025-01-01T00:00:00", 1.0), ("t2", None, None, None), ("t3", "u", "2025-01-01T00:00:00", float("nan")),
           ("t4", "u", "2025-01-01T00:00:00", 0.0), ("t5", "u", "2025-01-01T00:00:00", -1.0), (None, None, None, -5.0)]
    rows = spark.createDataFrame(odd, "transaction_id string, user_id string, timestamp string, total double").withColumn("payment_method", F.lit(None).cast("string"))
    kept = rows.filter(loading.broken_rules("transactions") == 0)
    assert [r.transaction_id for r in kept.collect()] == [r.transaction_id for r in cleaning.clean_transactions(rows).collect()] == ["t1"]
    found = rows.agg(*loading.rule_counts("transactions", loading.broken_rules("transactions"))).first().asDict()
    assert found == {"rows in": 7, "rows kept": 1, "transaction_id missing": 2, "user_id missing": 2, "timestamp missing": 2, "total missing": 2, "total not positive": 3}


def test_repeated_keys_are_diverted(spark, tmp_path):
    folder = tmp_path / "json"
    folder.mkdir()
    rows = [user("a", 1, "2025-01-01T00:00:00", "x@x"), user("a", 2, "2025-01-01T00:00:00", "y@x"), user("b", 3, "2025-01-01T00:00:00", "x@x"),
            user("c", 4, "2025-01-01T00:00:00", "y@x"), user("d", 5, "2025-01-01T00:00:00", None), user("e", 6, "2025-01-01T00:00:00", None),
            user(None, 7, "2025-01-01T00:00:00", "n1"), user(None, 8, "2025-01-01T00:00:00", "n2")]
    (folder / "users.json").write_text(json.dumps(rows))
    report = counts(loading.load(spark, str(folder), str(tmp_path / "t"), entities=["users"]))["users"]
    # The second "a" and the second null id go by user_id; "b" by the email of "a"; "c" stays, as the row with its email went before.
    assert report["user_id repeated"] == 2 and report["email repeated"] == 1 and report["rows in"] == 8
    assert sorted(r.age for r in documents.read_landed(spark, str(tmp_path / "t"), "users").collect()) == [1, 4, 5, 6, 7]
    refused = loading.rejects(spark, str(tmp_path / "t"), "users").collect()
    assert sorted((r.position, r.reason) for r in refused) == [(1, "user_id repeated"), (2, "email repeated"), (7, "user_id repeated")]
    assert {json.loads(r.text)["age"] for r in refused} == {2, 3, 8}


def test_what_cannot_be_read_is_kept(spark, tmp_path):
    folder = tmp_path / "json"
    folder.mkdir()
    (folder / "sessions_0.json").write_text('[{"session_id": "s1", "duration_seconds": "long", "page_views": 5}, 7, null, [1], {"session_id": 2, "user_id": "u"}]')
    (folder / "sessions_1.json").write_text('[{"session_id": "s3"}, {"session')
    (folder / "sessions_2.json").write_text('{"session_id": "alone", "duration_seconds": 5}')
    (folder / "sessions_3.json").write_text("[]")
    (folder / "sessions_4.json").write_text("")
    report = counts(loading.load(spark, str(folder), str(tmp_path / "t"), entities=["sessions"]))["sessions"]
    assert (report["unreadable"], report["unreadable field"]) == (4, 1)
    rows = documents.read_landed(spark, str(tmp_path / "t"), "sessions").collect()
    assert sorted((r.session_id, r.duration_seconds) for r in rows if r.session_id != "2") == [("alone", 5), ("s1", None)] and len(rows) == 3
    refused = {(r.file[-6:-5], r.position): (r.reason, r.text) for r in loading.rejects(spark, str(tmp_path / "t"), "sessions").collect()}
    assert refused[("0", 0)][0] == "unreadable: duration_seconds, page_views" and '"long"' in refused[("0", 0)][1]
    assert refused[("0", 1)] == ("no document", "7") and refused[("0", 3)] == ("no document", "[1]")
    assert refused[("1", 0)] == ("malformed text", '[{"session_id": "s3"}, {"session')


def test_a_failed_load_leaves_the_table(spark, shop, monkeypatch):
    loading.load(spark, str(shop / "json"), str(shop / "t"), entities=["users"])
    before = sorted(map(str, documents.read_landed(spark, str(shop / "t"), "users").collect()))
    monkeypatch.setattr(loading, "key_conflicts", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        loading.load(spark, str(shop / "json"), str(shop / "t"), entities=["users"])
    assert sorted(map(str, documents.read_landed(spark, str(shop / "t"), "users").collect())) == before
    monkeypatch.undo()
    loading.load(spark, str(shop / "json"), str(shop / "t"), entities=["users"])
    assert sorted(map(str, documents.read_landed(spark, str(shop / "t"), "users").collect())) == before
