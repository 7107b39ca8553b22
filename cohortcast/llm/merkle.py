"""Operator 11: a Merkle manifest of a dataset, by a nested-struct rollup.

Each row is a leaf.  The leaves of a group (a language) are numbered by a sort whose range partitions are counted and added up, so
no group is ever numbered in one task.  That number's digits (WIDTH bits each) are the rank digits: within a block of
DIGITS digits, one digit after the other is grouped away and the children become structs within their parent's struct,
with the digests between them and the parent beside them.  All digits of a block share the block's one exchange.
The roots of the blocks are the leaves of the next pass, 1024 times smaller, until one node a group remains; the groups' roots go the
same way.  Proofs are emitted by opening the nested structs again, a digit at a time, by transform and explode and without
joins within a block; only a block (one row) is joined with the path above its root.  Nothing larger than a block is ever held.

A node is H of its children's digests, also where it has only one; the sole leaf of a group is its root.

Edge cases: nulls in any column are a leaf's ``-`` and a group or place of their own (first); empty texts have a length of
0; very long texts are hashed by a task each and not carried further; rows repeating a doc_id are ordered by leaf, equal rows
are leaves each and have the same proofs up to their places; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import join_checked, written

#: Levels of the tree that one rank digit stands for (a digit has 2 ** WIDTH values), and the digits within one block.
WIDTH = 5
DIGITS = 2
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts), 256)


def leaf(*values: Column) -> Column:
    """The digest of a row's values: ``-`` for null, else the length in bytes, a colon and the value."""
    def one(c):
        s = c.cast("string")
        return F.when(s.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s))
    return digest(*[one(c) for c in values])


def ranked(df: DataFrame, group: list[str], order: list[str]) -> DataFrame:
    """``df`` with pos, the row's number from 0 within its group, and n, the group's rows.  ``df`` must be cheap to read twice
    (a written table); the last of ``order`` should differ between rows, so that no range is hot."""
    by = [F.col(c).asc_nulls_first() for c in group + order]
    s = written(df.repartitionByRange(*by).sortWithinPartitions(*by).withColumn("_at", F.monotonically_increasing_id()),
                "ranked").withColumn("_p", F.shiftright("_at", 33))
    every = Window.partitionBy(*[F.col(c) for c in group])
    per = s.groupBy(*group, "_p").agg(F.min("_at").alias("_first"), F.count("*").alias("_n"))
    per = written(per.select(*[F.col(c).alias(f"_{c}") for c in group], F.col("_p").alias("_part"), "_first", (F.sum("_n").over(
        every.orderBy("_p")) - F.col("_n")).alias("_before"), F.sum("_n").over(every).alias("n")), "ranges")
    same = F.col("_p") == F.col("_part")
    for c in group:
        same &= F.col(c).eqNullSafe(F.col(f"_{c}"))
    return join_checked(s, per, same).select(
        *df.columns, (F.col("_at") - F.col("_first") + F.col("_before")).alias("pos"), "n")


def _levels(digests: Column, n: Column, below: int) -> Column:
    """The digests of a digit's nodes, halved WIDTH times: WIDTH + 1 arrays, the last of one digest.  ``below`` levels lie under
    the digit; where its tree of n leaves has come down to one node, that node is kept."""
    def halved(x, level):
        pair = lambda i: digest(F.get(x, 2 * i), F.coalesce(F.get(x, 2 * i + 1), F.lit("")))
        some = F.sequence(F.lit(0), F.shiftright(F.size(x) - 1, 1))
        return F.when(_alive(n, level + below), F.transform(some, pair)).otherwise(x)
    return F.aggregate(F.sequence(F.lit(0), F.lit(WIDTH - 1)), F.array(digests), lambda all_, level: F.concat(
        all_, F.array(halved(F.element_at(all_, -1), level))))


def _alive(n: Column, level: Column) -> Column:
    """Whether a tree of n leaves has several nodes ``level`` levels above them."""
    return F.call_function("shiftright", n - 1, level) > 0


def rise(nodes: DataFrame, digits: int) -> list[DataFrame]:
    """Passes of blocks (tree, block, n, node) over nodes (tree, pos, n, node struct<digest, ...>); n counts the nodes of
    the tree that enter the pass, the last pass has one block a tree."""
    passes, bits, rest = [], WIDTH * digits, (1 << WIDTH) - 1
    while True:
        cur = nodes.select("tree", F.shiftright("pos", bits).alias("block"), "n",
                           F.expr(f"pos & {(1 << bits) - 1}").alias("r"), "node").repartition("tree", "block")
        for k in range(digits):
            up = cur.groupBy("tree", "block", "n", F.shiftright("r", WIDTH).alias("up")).agg(F.sort_array(F.collect_list(
                F.struct(F.expr(f"cast(r & {rest} as int)").alias("digit"), "node"))).alias("kids"))
            up = up.withColumn("levels", _levels(F.transform("kids", lambda x: x.node.digest), F.col("n"), k * WIDTH))
            cur = up.select("tree", "block", "n", F.col("up").alias("r"), F.struct(
                F.get(F.get("levels", F.lit(WIDTH)), F.lit(0)).alias("digest"),
                F.slice("levels", 1, WIDTH).alias("levels"), "kids").alias("node"))
        blocks = written(cur.drop("r"), "blocks")
        passes.append(blocks)
        if not blocks.agg(F.max(F.shiftright(F.col("n") - 1, bits))).first()[0]:
            return passes
        nodes = blocks.select("tree", F.col("block").alias("pos"), (F.shiftright(F.col("n") - 1, bits) + 1).alias("n"),
                              F.struct("node.digest").alias("node"))


def sink(passes: list[DataFrame], digits: int, above: DataFrame) -> DataFrame:
    """tree, pos, node, steps (array<struct<before, after>>, from the leaf upwards) of every leaf, with the columns of ``above``
    (tree, steps, ...), the paths that begin at the trees' roots."""
    rows = None
    for blocks in reversed(passes):
        if rows is None:
            rows = join_checked(blocks, above, "tree")
        else:
            rows = join_checked(blocks, rows.drop("node").withColumnRenamed("pos", "block"), ["tree", "block"])
        rows = rows.withColumnRenamed("block", "pos")
        keep = [c for c in rows.columns if c not in ("pos", "node", "steps", "n")]
        for k in reversed(range(digits)):
            rows = rows.select(*keep, "n", "pos", "steps", F.col("node.levels").alias("levels"), F.explode("node.kids").alias(
                "kid"))

            def step(level):
                place = F.call_function("shiftright", F.col("kid.digit"), level)
                side = F.coalesce(F.get(F.get("levels", level), place + 1 - 2 * (place % 2)), F.lit(""))
                return F.struct(F.when(place % 2 == 1, side).otherwise("").alias("before"),
                                F.when(place % 2 == 0, side).otherwise("").alias("after"))
            own = F.filter(F.sequence(F.lit(0), F.lit(WIDTH - 1)), lambda level: _alive(F.col("n"), level + k * WIDTH))
            rows = rows.select(*keep, "n", (F.col("pos") * (1 << WIDTH) + F.col("kid.digit")).alias("pos"),
                               F.col("kid.node").alias("node"), F.concat(F.transform(own, step), "steps").alias("steps"))
        rows = rows.drop("n")
    return rows


def manifest(docs: DataFrame, fields: tuple[str, ...] = FIELDS, group: str = "lang", order: str = "doc_id",
             also: dict[str, Column] | None = None, digits: int = DIGITS) -> DataFrame:
    """doc_id, leaf, subroot, root, steps (the proof: what stands before and after the running digest, level by level), and the
    columns ``also`` computed from the row."""
    also = also or {}
    leaves = written(docs.select(F.col(group).alias("key"), F.col(order).alias("id"), leaf(*[F.col(c) for c in fields]).alias(
        "digest"), F.struct(F.lit(0).alias("none"), *[c.alias(n) for n, c in also.items()]).alias("more")).withColumn(
            "salt", F.xxhash64(F.monotonically_increasing_id())), "leaves")
    at = ranked(leaves, ["key"], ["id", "digest", "salt"])
    keys = written(at.where("pos = 0").select("key", F.col("n").alias("size")), "keys")
    trees = ranked(keys, [], ["key"]).select(F.col("key").alias("group"), F.col("pos").alias("tree"), F.col("n").alias("all"))
    nodes = join_checked(at, written(trees, "trees"), F.col("key").eqNullSafe(F.col("group"))).select(
        "tree", "pos", "n", F.struct("digest", "id", "more").alias("node"))
    passes = rise(nodes, digits)
    n = keys.count()
    roots = passes[-1].select(F.lit(0).cast("long").alias("tree"), F.col("tree").alias("pos"), F.lit(n).cast("long").alias(
        "n"), F.struct("node.digest").alias("node"))
    crown = rise(roots, digits)
    top = crown[-1].select("tree", F.array().cast("array<struct<before:string,after:string>>").alias("steps"),
                           F.col("node.digest").alias("root"))
    paths = written(sink(crown, digits, top).select(
        F.col("pos").alias("tree"), "steps", F.col("node.digest").alias("subroot"), "root"), "paths")
    rows = sink(passes, digits, paths)
    return rows.select(F.col("node.id").alias(order), F.col("node.digest").alias("leaf"), "subroot", "root", "steps", *[
        F.col(f"node.more.{c}").alias(c) for c in also])


def proof(steps: Column) -> Column:
    """The digest of all siblings of a proof."""
    return F.sha2(F.array_join(F.transform(steps, lambda s: F.concat(s.before, s.after)), ""), 256)


def folded(start: Column, steps: Column) -> Column:
    """The root that a leaf and its proof lead to."""
    return F.aggregate(steps, start, lambda x, s: digest(s.before, x, s.after))
