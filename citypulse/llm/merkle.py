"""Merkle manifest of a data set by slot pivots.

Rows are leaves of one tree per group, in order; the groups' roots are the leaves of
one more tree. Where each node stands is known before any is hashed, so a level needs
no join: nodes are dealt once by blocks of ``fanout ** LEVELS`` neighbours, and there
each level is a conditional aggregate per slot over the nodes that share a parent:
``fanout`` columns, whose concatenation is hashed, and which without a node's own
slot are its siblings. The blocks' hashes are the next, far smaller, round of nodes.

A round's blocks are worked on twice: first for their hashes, then again, with the path
from above joined to each block, for the siblings of every node; siblings are
never shuffled or written. All is done by Spark's own functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from citypulse.llm import common

LEVELS = 6
_PATH = "array<struct<before:string,after:string>>"


def digest(*parts: Column) -> Column:
    """Lower-case hex SHA-256 of some strings' bytes, one after another."""
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def field(value: Column) -> Column:
    """A value as ``bytes:value``, null as ``-``."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def placed(rows: DataFrame, order: list[str]) -> DataFrame:
    """``rows`` (with a group ``g``) as a written table with the place of each in its group,
    ``pos`` from 0 by ``order``, and the group's size ``n``.

    Rows are dealt by ranges of group and order, so that a group of any size is
    spread; a row's number in its range less that of the range's first row
    of the group, plus the group's rows in earlier ranges, is its place."""
    numbered = common.written(rows.withColumn("row_", F.monotonically_increasing_id()), "merkle-rows")
    keys = ["g", *order, "row_"]  # equal rows are dealt apart too
    ranged = common.written(
        numbered.repartitionByRange(*keys).sortWithinPartitions(*keys)
        .withColumn("row_", F.monotonically_increasing_id()).withColumn("range_", F.shiftright("row_", 33)), "merkle-ranges")
    common.dropped(numbered)
    size = ranged.groupBy("g", "range_").agg(F.min("row_").alias("first_"), F.count(F.lit(1)).alias("many_"))
    own = Window.partitionBy("g")
    before = F.sum("many_").over(own.orderBy("range_")) - F.col("many_")
    size = size.select("g", "range_", (before - F.col("first_")).alias("shift_"), F.sum("many_").over(own).alias("n"))
    return ranged.join(size, ["g", "range_"]).withColumn("pos", F.col("row_") + F.col("shift_")).drop("row_", "range_", "shift_")


def climbed(nodes: DataFrame, fanout: int) -> DataFrame:
    """``nodes`` (g, pos, n, h and more) with their ``block``, the hash ``top`` of its
    highest node, and the siblings of each node on the way there (``path``)."""
    width = fanout ** LEVELS
    out = nodes.withColumn("block", F.expr(f"pos div {width}")).repartition("g", "block")
    out = out.withColumns({f"up{level + 1}": F.expr(f"pos div {fanout ** (level + 1)}") for level in range(LEVELS)})
    # coarse keys first: one sort serves the windows of all levels
    above = [f"up{level + 1}" for level in reversed(range(LEVELS))]
    out = out.withColumn("top", F.col("h"))
    steps = []
    for level in range(LEVELS):
        slot = F.expr(f"pos div {fanout ** level} % {fanout}")
        several = F.col("n") > fanout ** level  # a single node is hashed no more
        same_parent = Window.partitionBy("g", "block", *above[:LEVELS - level])
        slots = [f"slot{s}" for s in range(fanout)]
        out = out.withColumns({c: F.max(F.when(slot == s, F.col("top"))).over(same_parent) for s, c in enumerate(slots)})
        side = lambda keep: F.concat(*[F.when(keep(s), F.coalesce(c, F.lit(""))).otherwise("") for s, c in enumerate(slots)])  # noqa: E731,B023
        step = F.struct(side(lambda s: slot > s).alias("before"), side(lambda s: slot < s).alias("after"))  # noqa: B023
        out = out.withColumns({
            f"step{level}": F.when(several, step),
            "top": F.when(several, digest(*[F.coalesce(c, F.lit("")) for c in slots])).otherwise(F.col("top"))})
        steps.append(f"step{level}")
    path = F.filter(F.array(*steps), lambda x: x.isNotNull()).cast(_PATH)
    return out.withColumn("path", path).drop(*steps, *slots, *above)


def _proven(nodes: DataFrame, fanout: int, most: int, finish) -> DataFrame:
    """``nodes`` with ``path`` and what ``finish`` adds: it gets the table of the groups' last
    nodes (g, h), one a group, and returns it with ``path`` and further columns."""
    if most <= 1:
        return finish(nodes)
    up = climbed(nodes, fanout)
    width = fanout ** LEVELS
    blocks = (up.where(F.pmod("pos", F.lit(width)) == 0)
              .select("g", F.col("block").alias("pos"), F.expr(f"(n + {width - 1}) div {width}").alias("n"), F.col("top").alias("h")))
    blocks = common.written(blocks, "merkle-blocks")
    above = _proven(blocks, fanout, -(-most // width), finish)
    above = above.drop("n", "h").withColumnsRenamed({"pos": "block", "path": "higher"})
    joined = up.join(above, ["g", "block"])
    return joined.withColumn("path", F.concat("path", "higher")).drop("block", "top", "higher")


def manifest(rows: DataFrame, group: Column, leaf: Column, order: list[str], fanout: int = 3,
             keep: list[Column] | None = None) -> DataFrame:
    """A row per input row: ``keep`` columns, leaf, path (the concatenated siblings before and
    after the node, level by level, in its group's tree and then in the tree of
    group roots), subroot and root.

    Leaves of a group stand by ``order`` (columns of ``keep``, null first), ties by leaf;
    groups by their UTF-8 bytes, null first. While several nodes remain, each run of
    ``fanout`` neighbours (the last may have fewer, even one) becomes the hash of their
    concatenated hex digests; a lone leaf is its tree's root. Repeated rows are leaves of
    their own. An empty table gives no rows. Columns of ``rows`` that are not kept do not
    appear; ``keep`` must not be named g, h, n, pos, path, leaf, block, top, subroot or root."""
    g = F.coalesce(F.concat(F.lit("="), group.cast("string")), F.lit(""))  # null first, and not the empty text
    leaves = rows.select(*(keep or []), g.alias("g"), leaf.alias("h"))
    leaves = placed(leaves, [*order, "h"])
    most = leaves.agg(F.max("n")).first()[0] or 0

    def top_tree(last: DataFrame) -> DataFrame:
        subroots = last.select("g", F.col("h").alias("subroot"))
        one = placed(subroots.select(F.lit("").alias("g"), F.col("g").alias("name"), F.col("subroot").alias("h")), ["name"])
        many = one.count()
        done = lambda x: x.select("g", F.col("h").alias("root"), *[c for c in x.columns if c not in ("g", "h")],
                                  F.array().cast(_PATH).alias("path"))
        proven = _proven(one, fanout, many, done)
        proven = proven.select(F.col("name").alias("g"), F.col("path"), "root")
        return last.withColumn("subroot", F.col("h")).join(proven, "g")

    return _proven(leaves, fanout, most, top_tree).withColumnRenamed("h", "leaf").drop("g", "n", "pos")


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its siblings give."""
    return F.aggregate(path, leaf, lambda node, step: digest(step["before"], node, step["after"]))


def proof(path: Column) -> Column:
    """The hash of all siblings, from the leaf up, left to right."""
    return digest(F.concat_ws("", F.transform(path, lambda step: F.concat(step["before"], step["after"]))))


#: fields of a document's leaf, in order
FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]


def document_manifest(docs: DataFrame, tampered_text: Column) -> DataFrame:
    """doc_id, leaf, subroot, root, path and changed (the leaf of the document with its text
    replaced by ``tampered_text``) of each document. A leaf hashes the ``FIELDS``, each
    as byte count, colon and value, or ``-`` for null; groups are sources, ordered by doc_id.

    Rows are leaves even where all fields are null, repeated or tied in doc_id (ties stand by
    leaf); further columns are not read. Texts are hashed where they are read."""
    fields = {c: field(F.col(c)) for c in FIELDS}
    leaf = digest(*fields.values())
    changed = digest(*{**fields, "text": field(tampered_text)}.values())
    return manifest(docs, F.col("source"), leaf, ["doc_id"], keep=[F.col("doc_id"), changed.alias("changed")])
