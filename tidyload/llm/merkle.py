"""Merkle manifest of a table with path-copying versions (operator 12).

Every row is a leaf: H (lowercase hex sha256 of the inputs concatenated, digests as hex
text) of some columns, each ``-`` if null, else its UTF-8 length in bytes, ``:`` and its
value as text. The leaves of a group ascend by id; while several nodes remain, every two
consecutive ones (the last run may hold one) become their H; what remains is the
group's subroot. The subroots, ordered by group (null first, UTF-8 bytewise), likewise
give the root. A proof is H of the siblings on the way from leaf to root.

Method: a persistent tree. Nodes are kept in aligned blocks of ``2 ** bits`` leaves. A
tampered leaf makes a version of its own: of its block only the leaf's ancestors are
copied, all other nodes are shared with the untampered tree; the copied top of the block
goes on as a row of its own, and above it again only ancestors are copied, from the
shared siblings that belong to the block. Untampered leaves copy nothing, their way up
is recomputed from the shared siblings alone and compared with the root.

Distribution. Leaves are placed by a range partition on (group, id, leaf), so neither a
group nor an id with a third of all rows meets in one task; a block holds at most
``2 ** bits`` rows. The tops of the blocks form the nodes of the next round, as many
rounds as the largest group needs (three for 10**9 rows); then the steps from each block
to the root are put together downwards, where a parent has at most ``2 ** bits``
children. Only digests are shuffled, never a text.

Defined cases: null groups are the first group, null ids come first in it and are never
tampered with by the query; rows of equal ids are ordered by leaf, so repeated rows,
whose leaves are equal, can change places without effect; empty and very long texts are
hashed whole; a null number stays null when tampered with; other columns of clashing
names are no matter, since leaves have columns of their own; an empty table gives an
empty result.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidyload.llm import common as C

BITS = 10


def encoded(c: Column) -> Column:
    text = c.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(columns: list[Column]) -> Column:
    return F.sha2(F.concat(*[encoded(c) for c in columns]), 256)


def group_key(c: Column) -> Column:
    """A text that is never null and sorts like the group, null first."""
    return F.coalesce(F.concat(F.lit("1"), c.cast("string")), F.lit(""))


def placed(rows: DataFrame, order: list[str]) -> DataFrame:
    """``rows`` (with a column ``tree``) with ``pos``, the place within the tree by
    ``order``, and ``size``, the tree's number of rows. Rows are range-partitioned and
    written once, and counts per partition and tree give the offsets."""
    by = [F.col(c).asc_nulls_first() for c in ["tree", *order]]
    ranked = C.written(
        rows.withColumn("_tie", F.monotonically_increasing_id()).repartitionByRange(*by, "_tie").sortWithinPartitions(*by)
        .withColumn("_part", F.spark_partition_id())
        .withColumn("_row", F.monotonically_increasing_id() - F.shiftleft(F.spark_partition_id().cast("long"), 33)))
    counts = ranked.groupBy("tree", "_part").agg(F.count("*").alias("_n"), F.min("_row").alias("_first"))
    whole = Window.partitionBy("tree")
    offsets = counts.select("tree", "_part", F.sum("_n").over(whole).alias("size"),
                            (F.sum("_n").over(whole.orderBy("_part")) - F.col("_n") - F.col("_first")).alias("_shift"))
    return ranked.join(offsets, ["tree", "_part"]).withColumn("pos", F.col("_row") + F.col("_shift")).drop(
        "_tie", "_part", "_row", "_shift")


def _h(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def levels(size: int, bits: int) -> int:
    """Levels that a block of a tree of ``size`` nodes has."""
    return min(bits, (size - 1).bit_length())


def block_tree(digests: list[str], height: int) -> list[list[str]]:
    """All levels of a block's nodes, the given ones first."""
    tree = [digests]
    for _ in range(height):
        below = tree[-1]
        tree.append([_h("".join(below[i: i + 2])) for i in range(0, len(below), 2)])
    return tree


def steps_up(tree: list[list[str]], place: int) -> list[str]:
    """Siblings of a node upwards: ``<`` or ``>`` (which side) and the digest, or empty if it has none."""
    out = []
    for nodes in tree[:-1]:
        other = place ^ 1
        out.append("" if other >= len(nodes) else ("<" if other < place else ">") + nodes[other])
        place >>= 1
    return out


def copied_path(digest: str, steps: list[str]) -> list[str]:
    """The ancestors of a node, from its digest and the siblings on its way."""
    out = []
    for s in steps:
        digest = _h(s[1:] + digest if s.startswith("<") else digest + s[1:])
        out.append(digest)
    return out


STEPS = "tree string, pos long, block long, block_size long, steps array<string>, top string"


def _steps(bits: int):
    """Siblings within its block of every node, and the block's top."""
    def run(table):
        import pyarrow as pa

        rows = table.sort_by("pos")
        pos, size = rows["pos"].to_pylist(), rows["size"][0].as_py()
        tree = block_tree(rows["digest"].to_pylist(), levels(size, bits))
        n = len(pos)
        return pa.table({"tree": rows["tree"], "pos": rows["pos"], "block": pa.array([p >> bits for p in pos], pa.int64()),
                         "block_size": pa.array([-(-size >> bits)] * n, pa.int64()),
                         "steps": pa.array([steps_up(tree, place) for place in range(n)], pa.list_(pa.string())),
                         "top": pa.array([tree[-1][0]] * n, pa.string())})
    return run


def climb(nodes: DataFrame, bits: int = BITS) -> DataFrame:
    """(tree, pos, steps, root) for nodes (tree, pos, size, digest): the siblings from
    each node to the root of its tree."""
    largest = nodes.agg(F.max("size")).first()[0] or 0
    own = C.written(nodes.groupBy("tree", F.shiftright("pos", bits)).applyInArrow(_steps(bits), STEPS))
    if largest <= 1 << bits:
        return own.select("tree", "pos", "steps", F.col("top").alias("root"))
    tops = own.where(F.col("pos") % (1 << bits) == 0).select("tree", F.col("block").alias("pos"), F.col("block_size").alias("size"), F.col("top").alias("digest"))
    above = climb(tops, bits).select("tree", F.col("pos").alias("block"), F.col("steps").alias("on"), "root")
    return C.written(own.join(above, ["tree", "block"]).select("tree", "pos", F.concat("steps", "on").alias("steps"), "root"))


TOPS = "tree string, pos long, size long, digest string"
VERSIONS = "id long, tree string, block long, leaf string, altered string, siblings binary, copied array<string>, top string"


def _top(bits: int):
    """The top of a block of leaves."""
    def run(table):
        import pyarrow as pa

        rows = table.select(["tree", "pos", "leaf", "size"]).sort_by("pos")
        size = rows["size"][0].as_py()
        tree = block_tree(rows["leaf"].to_pylist(), levels(size, bits))
        return pa.table({"tree": rows["tree"][:1], "pos": pa.array([rows["pos"][0].as_py() >> bits], pa.int64()),
                         "size": pa.array([-(-size >> bits)], pa.int64()), "digest": pa.array([tree[-1][0]], pa.string())})
    return run


def _versions(bits: int):
    """Each leaf's siblings within the block, the ancestors its version copies there, and the version's top."""
    def run(table):
        import pyarrow as pa

        rows = table.sort_by("pos")
        leaf, altered, pos = rows["leaf"].to_pylist(), rows["altered"].to_pylist(), rows["pos"].to_pylist()
        tree = block_tree(leaf, levels(rows["size"][0].as_py(), bits))
        siblings, copied, tops = [], [], []
        for place, (own, new) in enumerate(zip(leaf, altered)):
            steps = steps_up(tree, place)
            path = [own if new is None else new, *copied_path(own if new is None else new, steps)]
            siblings.append(bytes.fromhex("".join(s[1:] for s in steps)))
            copied.append([] if new is None else path[1:])
            tops.append(path[-1])
        return pa.table({"id": rows["id"], "tree": rows["tree"], "block": pa.array([p >> bits for p in pos], pa.int64()),
                         "leaf": rows["leaf"], "altered": rows["altered"], "siblings": pa.array(siblings, pa.binary()),
                         "copied": pa.array(copied, pa.list_(pa.string())), "top": pa.array(tops, pa.string())})
    return run


def manifest(docs: DataFrame, columns: list[str], id_col: str = "doc_id", group_col: str = "lang",
             tampered: dict[str, Column] | None = None, where: Column | None = None, bits: int = BITS) -> DataFrame:
    """The manifest of ``docs`` with one version for each tampered row: ``id``, ``leaf``,
    ``altered`` (the tampered leaf, else null), ``subroot``, ``root`` and ``proof`` of the
    untampered tree, ``copied`` (the ancestors that the row's version copied, from the
    leaf's parent to its root; null if untampered) and ``folded`` (the root of the
    version, or that recomputed from the leaf and its siblings).

    ``columns`` make up a leaf. ``tampered`` gives other values for some of them, in the
    rows for which ``where`` holds."""
    other = [(tampered or {}).get(c, F.col(f"`{c}`")) for c in columns]
    changed = F.coalesce(F.lit(True) if where is None else where, F.lit(False)) if tampered else F.lit(False)
    C.ship(docs.sparkSession)
    leaves = C.written(docs.select(
        F.col(f"`{id_col}`").cast("long").alias("id"), group_key(F.col(f"`{group_col}`")).alias("tree"),
        leaf_digest([F.col(f"`{c}`") for c in columns]).alias("leaf"),
        F.when(changed, leaf_digest(other)).alias("altered")))
    leaves = C.written(placed(leaves, ["id", "leaf"]))
    blocks = leaves.groupBy("tree", F.shiftright("pos", bits).alias("block"))
    up = climb(C.written(blocks.applyInArrow(_top(bits), TOPS)), bits)

    subroots = up.where("pos = 0").select("tree", F.col("root").alias("digest"))
    numbered = placed(subroots.withColumnRenamed("tree", "name").withColumn("tree", F.lit("")), ["name"])
    groups = C.written(numbered)
    last = climb(groups.select("tree", "pos", "size", "digest"), bits).select("pos", F.col("steps").alias("on"), F.col("root").alias("whole"))
    by_group = groups.select(F.col("name").alias("tree"), "pos").join(last, "pos").drop("pos")
    shared = C.written(up.join(by_group, "tree").select(
        "tree", F.col("pos").alias("block"), F.concat("steps", "on").alias("steps"), F.col("root").alias("subroot"), F.col("whole").alias("root"),
        F.array_join(F.transform(F.concat("steps", "on"), lambda s: F.substr(s, F.lit(2))), "").alias("rest")))

    versions = blocks.applyInArrow(_versions(bits), VERSIONS).join(shared, ["tree", "block"])
    folds = F.aggregate("steps", F.array("top"), lambda made, s: F.concat(made, F.array(F.sha2(
        F.when(s.startswith("<"), F.concat(F.substr(s, F.lit(2)), F.element_at(made, -1)))
        .otherwise(F.concat(F.element_at(made, -1), F.substr(s, F.lit(2)))), 256))))
    return versions.withColumn("folds", folds).select(
        "id", "leaf", "altered", "subroot", "root", F.sha2(F.concat(F.lower(F.hex("siblings")), "rest"), 256).alias("proof"),
        F.when(F.col("altered").isNotNull(), F.concat("copied", F.slice("folds", F.lit(2), F.size("folds") - 1))).alias("copied"),
        F.element_at("folds", -1).alias("folded"))
