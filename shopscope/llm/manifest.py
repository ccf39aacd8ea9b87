"""Merkle manifest of a dataset, leaves placed by bitmap rank (operator 13).

Every row is a leaf: the SHA-256 of its fields, each ``-`` if null, else its length in UTF-8 bytes, ``:`` and itself. The leaves of a
language ascend by doc_id; every 8 consecutive ones are hashed together, and so on up to the language's root; the roots of the
languages, in order, make one more tree. No column is sorted to find a leaf's place:

1. *Bitmaps.* The ids of a language form a bitmap, compressed by leaving out empty words: a row (word number, 64 bits) for each word
   that has a bit, merged by ``bit_or`` from all tasks. An id that occurs more than once also stands in its word's short list of repeats.
2. *Popcount directory.* Rows are counted per word, per 2 ** 16, 2 ** 32 and 2 ** 48 ids; at every level the counts before an entry are summed within
   its parent only, so no window holds more than 2 ** 16 entries, whatever the ids look like.
3. *Rank.* A leaf's coordinate is the count before its word plus the bits set below its own: a join on the word, of which each holds 64 ids.
4. *Slot arrays.* Leaf r goes to place r % 8 of slot r / 8; slots are grouped by key, hashed, and are the leaves of the next level.
   Going down again, every node hands its siblings on to the nodes below it, so a leaf's proof needs no look-up of its own.

Rows that share language and doc_id, or have a null id (which goes before all others), are in order of their leaf; the same index is
built over the first 60 bits of the leaves in such an id, so an id that a third of all rows share is split like all else. Equal rows are counted before they are shuffled
and take consecutive places; which of them has which proof is not told. A null lang is a language of its own, first of all. A single leaf is its language's root.
An empty table has no rows. Texts of any length are hashed in place and not shuffled. Columns beside the five fields are not read.

Languages are taken to be few (names of languages): they are numbered in one ordered window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from shopscope.session import stored

FAN = 8
CHUNK = 4096
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def field(value: Column) -> Column:
    """A field as it enters a leaf."""
    text = value.cast("string")
    return F.when(value.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts), 256)


def tampered(doc_id: Column) -> Column:
    """Rows whose text is changed for the test: 3 divides the crc32 of the id as text."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 0, F.lit(False))


def leaves(docs: DataFrame) -> DataFrame:
    """(grp, doc_id, leaf, bent, n): every different row once, with how often it occurs.

    ``bent`` is the leaf after tampering. ``grp`` names the language so that null goes before all names.
    """
    head = [field(F.col(c)) for c in ("doc_id", "source", "lang", "n_chars")]
    text = F.col("text")
    leaf = digest(*head, field(text))
    bent = F.when(tampered(F.col("doc_id")), digest(*head, field(F.translate(text, UPPER, LOWER)))).otherwise(F.col("leaf"))
    grp = F.when(F.col("lang").isNull(), F.lit("")).otherwise(F.concat(F.lit("="), F.col("lang")))
    rows = docs.withColumns({"grp": grp, "leaf": leaf}).select("grp", "doc_id", "leaf", bent.alias("bent"))
    return rows.groupBy("grp", "doc_id", "leaf", "bent").agg(F.count(F.lit(1)).alias("n"))


#: Bits of an id below a word, and below each level of the directory above it.
WORD, LEVELS = 6, (16, 32, 48)


def index(counted: DataFrame) -> DataFrame:
    """The bitmaps of all groups with their directory: (grp, word, bits, repeats, before).

    ``counted`` holds (grp, key, n), a key once per group; a null key goes before all others and has no bits.
    """
    at = F.col("key").bitwiseAND((1 << WORD) - 1).cast("int")
    words = counted.withColumn("at", at).groupBy("grp", F.shiftright("key", WORD).alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, at)")).alias("bits"), F.sum("n").alias("n"),
        F.collect_list(F.when(F.col("n") > 1, F.struct("at", (F.col("n") - 1).alias("more")))).alias("repeats"))
    levels = [words]
    for low, high in zip((WORD, *LEVELS), LEVELS):
        levels.append(levels[-1].groupBy("grp", F.shiftright("word", high - low).alias("word")).agg(F.sum("n").alias("n")))

    def summed(level: DataFrame, parent: Column) -> DataFrame:
        earlier = W.partitionBy("grp", parent).orderBy("word").rowsBetween(W.unboundedPreceding, -1)
        return level.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0))).drop("n")

    above = summed(levels[-1], F.lit(0))
    for level, low, high in reversed(list(zip(levels, (WORD, *LEVELS), LEVELS))):
        parent = F.shiftright("word", high - low)
        upper = above.select(F.col("grp").alias("g"), F.col("word").alias("w"), F.col("before").alias("base"))
        own = summed(level, parent)
        above = own.join(upper, (F.col("grp") == F.col("g")) & parent.eqNullSafe(F.col("w"))).withColumn(
            "before", F.col("before") + F.col("base")).drop("g", "w", "base")
    return above


def ranks(rows: DataFrame) -> DataFrame:
    """``rows`` (grp, key, order, n, ...) with ``rank``, the number of rows before them in their group, by key.

    Rows of one key are in order of ``order``: few of them, or see ``placed``.
    """
    counted = rows.groupBy("grp", "key").agg(F.sum("n").alias("n"))
    found = index(counted).select(F.col("grp").alias("g"), F.col("word").alias("w"), "bits", "repeats", "before")
    at = F.col("key").bitwiseAND((1 << WORD) - 1).cast("int")
    below = F.bit_count(F.col("bits").bitwiseAND(F.expr("~shiftleft(-1L, at)")))
    more = F.expr("aggregate(filter(repeats, r -> r.at < at), 0L, (total, r) -> total + r.more)")
    joined = rows.withColumn("at", at).join(
        found, (F.col("grp") == F.col("g")) & F.shiftright("key", WORD).eqNullSafe(F.col("w")))
    # A null key has no bits and is the first of its group.
    return joined.withColumn("rank", F.col("before") + F.coalesce(below + more, F.lit(0))).drop("at", "g", "w", "bits", "repeats", "before")


def placed(entries: DataFrame) -> DataFrame:
    """(grp, doc_id, leaf, bent, rank): a row for every leaf, at its place in its language."""
    by_id = ranks(entries.withColumn("key", F.col("doc_id"))).drop("key")
    kinds = entries.groupBy("grp", "doc_id").agg(F.count(F.lit(1)).alias("kinds")).filter("kinds > 1").select(
        F.col("grp").alias("g"), F.col("doc_id").alias("d"))
    shared = stored(kinds, "shared_ids")
    if not shared.isEmpty():
        same = (F.col("grp") == F.col("g")) & F.col("doc_id").eqNullSafe(F.col("d"))
        lone = by_id.join(shared, same, "left_anti")
        clash = by_id.join(shared, same, "left_semi").select(
            F.concat_ws("/", F.col("grp"), F.coalesce(F.col("doc_id").cast("string"), F.lit("-"))).alias("grp"), F.col("grp").alias("lang_grp"),
            "doc_id", "leaf", "bent", "n", F.col("rank").alias("base"), F.conv(F.substring("leaf", 1, 15), 16, 10).cast("long").alias("key"))
        # Leaves of one id that agree in 60 bits, if ever, are in order of the rest.
        ties = W.partitionBy("grp", "key").orderBy("leaf").rowsBetween(W.unboundedPreceding, -1)
        within = ranks(clash).withColumn("tie", F.coalesce(F.sum("n").over(ties), F.lit(0)))
        by_id = lone.unionByName(within.select(
            F.col("lang_grp").alias("grp"), "doc_id", "leaf", "bent", "n", (F.col("base") + F.col("rank") + F.col("tie")).alias("rank")))
    # Equal rows take places one after the other, in chunks.
    chunk = F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1, F.lit(CHUNK).cast("long")))
    one = F.explode(F.sequence(F.lit(0).cast("long"), F.least(F.lit(CHUNK).cast("long"), F.col("n") - F.col("chunk")) - 1))
    return by_id.withColumn("chunk", chunk).withColumn("one", one).select(
        "grp", "doc_id", "leaf", "bent", (F.col("rank") + F.col("chunk") + F.col("one")).alias("rank"))


def slots(nodes: DataFrame, *also: str) -> DataFrame:
    """(grp, slot, size, run, node): nodes (grp, at, hash, size) gathered by slot; ``run`` holds them in order.

    ``node`` is the digest of the run; a group of one node stays as it is.
    """
    run = F.array_sort(F.collect_list(F.struct("at", "hash", *also)))
    joined = F.concat_ws("", F.col("run.hash"))
    return nodes.groupBy("grp", F.expr(f"at div {FAN}").alias("slot")).agg(F.first("size").alias("size"), run.alias("run")).withColumn(
        "node", F.when(F.col("size") > 1, F.sha2(joined, 256)).otherwise(F.col("run")[0]["hash"]))


def nodes_of(level: DataFrame) -> DataFrame:
    """The nodes that the slots of a level make."""
    return level.select("grp", F.col("slot").alias("at"), F.col("node").alias("hash"), F.expr(f"(size + {FAN - 1}) div {FAN}").alias("size"))


def tree(first: DataFrame) -> list[DataFrame]:
    """The levels of slots, stored, from the leaves' up to one slot per group."""
    levels = [first]
    while not levels[-1].filter(F.col("size") > FAN).isEmpty():
        levels.append(stored(slots(nodes_of(levels[-1])), "slots"))
    return levels


def step(run: str, place: str, size: str) -> Column:
    """What stands left and right of a place of a run, as an array of one step, or of none in a group of one node."""
    return F.expr(
        f"CASE WHEN {size} > 1 THEN array(named_struct('l', concat_ws('', slice({run}.hash, 1, {place})), 'r', concat_ws('', slice({run}.hash, {place} + 2, {FAN})))) "
        "ELSE array() END")


def descend(levels: list[DataFrame], top: DataFrame) -> DataFrame:
    """(g, s, above) for the slots of the first level; ``top`` holds (g, above) of each group.

    ``above`` lists, from the bottom, what stands beside the path from a slot to the root.
    """
    above = top.select("g", F.lit(0).cast("long").alias("s"), "above")
    for level in reversed(levels[1:]):
        known = level.join(above, (F.col("grp") == F.col("g")) & (F.col("slot") == F.col("s")))
        above = known.select(F.col("grp").alias("g"), F.col("above").alias("higher"), "size", "run", F.posexplode("run").alias("place", "child")).select(
            "g", F.col("child.at").alias("s"), F.concat(step("run", "place", "size"), "higher").alias("above"))
    return above


def manifest(docs: DataFrame) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified) per row of ``docs``. Runs jobs.

    The proof is the digest of the siblings on the way to the root; ``folded_root`` climbs it again from the tampered leaf.
    """
    entries = stored(leaves(docs), "leaves")
    sizes = entries.groupBy("grp").agg(F.sum("n").alias("size"))
    spots = placed(entries).select("grp", F.col("rank").alias("at"), F.col("leaf").alias("hash"), "bent", "doc_id")
    first = stored(slots(spots.join(sizes, "grp"), "bent", "doc_id"), "slots")
    levels = tree(first)
    # One row per language from here.
    last = levels[-1].select(F.col("grp").alias("name"), F.col("node").alias("hash"))
    names = stored(last.withColumns({
        "at": (F.row_number().over(W.orderBy("name")) - 1).cast("long"), "size": F.count(F.lit(1)).over(W.partitionBy()), "grp": F.lit("")}), "languages")
    upper = tree(stored(slots(names, "name"), "slots"))
    root = upper[-1].select(F.col("grp").alias("g"), F.col("node").alias("root"))
    none = F.array().cast("array<struct<l:string,r:string>>")
    runs = upper[0].join(descend(upper, root.select("g", none.alias("above"))), (F.col("grp") == F.col("g")) & (F.col("slot") == F.col("s"))).drop("g", "s")
    languages = runs.join(root, F.col("grp") == F.col("g")).select("root", "above", "size", "run", F.posexplode("run").alias("place", "child"))
    tops = stored(languages.select(F.col("child.name").alias("g"), F.col("child.hash").alias("subroot"), "root",
                                   F.concat(step("run", "place", "size"), "above").alias("above")), "tops")

    beside = descend(levels, tops.select("g", "above"))
    found = first.join(beside, (F.col("grp") == F.col("g")) & (F.col("slot") == F.col("s"))).drop("g", "s").join(
        tops.select(F.col("g"), "subroot", "root"), F.col("grp") == F.col("g"))
    path = found.select("subroot", "root", "size", "run", "above", F.posexplode("run").alias("place", "child")).select(
        F.col("child.doc_id").alias("doc_id"), F.col("child.hash").alias("leaf"), F.col("child.bent").alias("bent"), "subroot", "root",
        F.concat(step("run", "place", "size"), "above").alias("path"))
    proof = F.sha2(F.array_join(F.transform("path", lambda s: F.concat(s["l"], s["r"])), ""), 256)
    folded = F.aggregate("path", F.col("bent"), lambda h, s: F.sha2(F.concat(s["l"], h, s["r"]), 256))
    return path.select("doc_id", "leaf", "subroot", "root", proof.alias("proof_sha256"), folded.alias("folded_root")).withColumn(
        "verified", F.col("folded_root") == F.col("root"))
