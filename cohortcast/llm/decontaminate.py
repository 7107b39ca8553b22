"""Operator 2: benchmark decontamination, DataFrame functions only.

A test item is found in a document if the document holds at least three quarters of the item's distinct five-word
shingles.  Items are put into classes by the size of their sets, a power of two apart.  Of each item a MinHash sketch (its
smallest shingle hashes) is indexed; a class's sketch is as long as it must be that an item which is contained to
three quarters shares at least one value for certain: ``n - ceil(0.75 n) + 1`` of its n.  Documents are searched whole
for these values; a document too small for every class it was found in goes.  Candidates are then verified by counting the exact
shingles (as word sequences, not hashes) that document and item share.

The sketches, of the items alone, are broadcast when counted to be few; otherwise the shingle hashes are
shuffled to them, after a distinct per document.

Edge cases: null or wordless items are found nowhere, null or wordless documents hold nothing; a text of one to four words
is one shingle; repeated item rows with one id count as one item of their joint shingles; rows that repeat a doc_id count as one
document of their joint shingles; rows of null doc_id are never found to hold anything; words are compared in lower
case; further columns are ignored; an empty table on either side gives no matches.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import BROADCAST_ROWS, join_checked, written

K = 5
GAP = "[ \\t\\n\\x0B\\f\\r]+"


def _words(text: str) -> Column:
    return F.filter(F.split(F.lower(F.col(text)), GAP), lambda w: w != "")


def _starts(w: str) -> Column:
    """First index of each shingle (0-based); one for one to four words, none without words."""
    return F.when(F.size(w) > 0, F.sequence(F.lit(0), F.greatest(F.size(w) - K, F.lit(0)))).otherwise(
        F.array().cast("array<int>"))


def _hashes(w: str) -> Column:
    """The shingles' 64-bit hashes."""
    at = lambda i, j: F.get(F.col(w), i + j)
    return F.transform(_starts(w), lambda i: F.xxhash64(*[at(i, j) for j in range(K)]))


def _shingles(w: str) -> Column:
    return F.array_distinct(F.transform(_starts(w), lambda i: F.array_join(F.slice(F.col(w), i + 1, K), " ")))


def item_shingles(items: DataFrame) -> DataFrame:
    """(item_id, shingle, h, n): the distinct shingles of each item and their number."""
    rows = (items.where("item_id is not null").select(F.col("item_id").cast("long").alias("item_id"), _words("text").alias("w"))
            .select("item_id", F.explode_outer(_shingles("w")).alias("shingle")).where("shingle is not null").distinct())
    size = rows.groupBy("item_id").agg(F.count("*").alias("n"))
    part = F.transform(F.sequence(F.lit(0), F.lit(K - 1)), lambda j: F.get(F.split("shingle", " "), j))
    return rows.join(size, "item_id").select("item_id", "shingle", F.xxhash64(*[F.get(part, F.lit(j)) for j in range(K)])
                                             .alias("h"), "n")


def sketches(shingles: DataFrame) -> DataFrame:
    """(h, item_id, least): each item's smallest hashes, and the fewest shingles of a document that its class needs."""
    low = F.floor(F.log2("n"))                                     # the class: sizes from 2 ** low
    need = F.ceil(F.col("n") * 3 / 4)
    return (shingles.groupBy("item_id", "n").agg(F.sort_array(F.collect_set("h")).alias("hs"))
            .select("item_id", F.ceil(F.pow(F.lit(2), low) * 3 / 4).cast("int").alias("least"),
                    F.slice("hs", 1, (F.col("n") - need + 1).cast("int")).alias("hs"))
            .select(F.explode("hs").alias("h"), "item_id", "least"))


def contained(docs: DataFrame, items: DataFrame) -> DataFrame:
    """(doc_id, item_id, shared, n) of every item of which a document holds three quarters of the shingles or more."""
    shingles = written(item_shingles(items), "items")
    index = written(sketches(shingles), "sketch")
    docs = docs.where("doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    few = index.count() <= BROADCAST_ROWS
    hashed = docs.select("doc_id", _words("text").alias("w")).select("doc_id", _hashes("w").alias("hs"))
    if few:
        index = F.broadcast(index)
    else:
        hashed = hashed.withColumn("hs", F.array_distinct("hs"))
    # explode would infer a filter on the array, which is pushed below the words and splits the text once a shingle
    seen = hashed.select("doc_id", F.explode_outer("hs").alias("h"))
    candidates = written(seen.join(index, "h").select("doc_id", "item_id", "least").distinct(), "found")
    fewest = written(candidates.groupBy("doc_id").agg(F.min("least").alias("fewest")), "fewest")
    held = (join_checked(docs, fewest, "doc_id").select("doc_id", "fewest", _words("text").alias("w"))
            .where(F.greatest(F.size("w") - (K - 1), F.lit(1)) >= F.col("fewest"))
            .select("doc_id", F.explode_outer(_shingles("w")).alias("shingle")))
    if few:                                       # only shingles of some item matter
        held = held.join(F.broadcast(shingles.select("shingle").distinct()), "shingle", "left_semi")
    wanted = candidates.join(shingles, "item_id")
    shared = (held.distinct().join(wanted, ["doc_id", "shingle"]).groupBy("doc_id", "item_id", "n")
              .agg(F.count("*").alias("shared")))
    return shared.where(F.col("shared") * 4 >= F.col("n") * 3).select("doc_id", "item_id", "shared", "n")


def marked(docs: DataFrame, items: DataFrame) -> DataFrame:
    """(doc_id, n_items, first_item, item_ids) of the documents that hold items: how many, the smallest id, all ids."""
    return contained(docs, items).groupBy("doc_id").agg(
        F.count("*").alias("n_items"), F.min("item_id").alias("first_item"),
        F.array_join(F.sort_array(F.collect_set("item_id")), ",").alias("item_ids"))
