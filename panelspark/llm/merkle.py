"""Operator 12: a Merkle manifest of a table, with a proof for every row.

Every row is a leaf: the hash of its fields.  Leaves of a group (source) ascend by id; runs of ``fanout`` neighbours
become the hash of their digests until one node, the group's subroot, is left; the subroots, in order of their groups,
go on in the same way up to the root.

Slot pivot: the children of a parent are spread by conditional aggregates into ``fanout`` slot columns, one per
place in the run.  All slots in a row hash to the parent; all but a child's own slot are its siblings.  The first
level's slots hold the rows themselves, so no row is joined again with its digest.  Paths are handed down from the root:
a node's path is its siblings, then its parent's path, so a path's upper part is made once per parent.

Places come from one range-sorted numbering of the whole table (ties by digest, then by the row's place in the files),
so a group may hold any share of the rows.  A group's first number and size (one row per group) are
joined by broadcast behind a size check, and beyond it over 64 copies, so a large group is dealt over 64 keys.  Levels
are written to the checkpoint folder; only the largest group's size, the number of groups and the root reach the driver.

Results for odd input: null fields hash as ``-``; empty texts as ``0:``; rows of one id stand in a row, equal rows in any
order (their digests are equal); the null group comes first; a null id comes first in its group and is never offered changed;
an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelspark.operators.frames import fits_broadcast
from panelspark.operators.growth import GIDX, with_global_index

FANOUT = 16
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
SALTS = 64
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
STEP = "array<struct<left: string, right: string>>"


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts), 256)


def field(value: Column) -> Column:
    """``-`` for null, else UTF-8 bytes, ``:``, value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(**values: Column) -> Column:
    """Digest of a row's fields, in the given order."""
    return digest(*[field(v) for v in values.values()])


def tampered(id_column: Column, text: Column) -> Column:
    """The text in lower case (A-Z) where 5 divides the crc32 of the id, else the text."""
    chosen = F.coalesce(F.crc32(id_column.cast("string")) % 5 == 0, F.lit(False))
    return F.when(chosen, F.translate(text, UPPER, LOWER)).otherwise(text)


def _places(docs: DataFrame, id_col: str, group_col: str, fields: Sequence[str], text_col: str) -> tuple[DataFrame, int, int]:
    """Leaves with their tree (the group's number), its size and the place there; the largest size, the number of groups."""
    of = {c: F.col(f"`{c}`") for c in fields}
    other = of | {text_col: tampered(F.col(f"`{id_col}`"), F.col(f"`{text_col}`"))}
    rows = docs.select(
        F.coalesce(F.concat(F.lit("="), F.col(f"`{group_col}`").cast("string")), F.lit("-")).alias("g"),     # "-" comes before "="
        F.col(f"`{id_col}`").alias("id"), leaf_digest(**of).alias("digest"),
        F.when(~other[text_col].eqNullSafe(of[text_col]), leaf_digest(**other)).alias("offered"),
        F.monotonically_increasing_id().alias("place")).withColumn("known", F.col("id").isNotNull())
    order = ["g", "known", "id", "digest", "place"]
    placed = with_global_index(rows.select("g", "known", "id", "digest", "place", "offered"), order, name="at")
    groups = placed.groupBy("g").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n"))
    groups = with_global_index(groups, ["g"]).withColumnRenamed(GIDX, "tree")
    most, trees = groups.agg(F.max("n"), F.count(F.lit(1))).first()
    if fits_broadcast(groups):
        joined = placed.join(F.broadcast(groups), "g")
    else:
        copies = groups.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        joined = placed.withColumn("salt", (F.col("at") % SALTS).cast("int")).join(copies, ["g", "salt"])
    leaves = joined.select("tree", "n", (F.col("at") - F.col("first")).alias("pos"), "digest", F.struct("id", "offered").alias("row"))
    return leaves, most or 0, trees


def _gather(nodes: DataFrame, fanout: int, carried: Sequence[str] = ()) -> DataFrame:
    """Parents (tree, their number in the tree, place, digest, slots) of nodes (tree, n, pos, digest and what is carried).

    A tree of one node is not hashed: its node goes up as it is.
    """
    item = F.struct("digest", *carried)
    slot = [F.max(F.when(F.col("pos") % fanout == i, item)).alias(f"s{i}") for i in range(fanout)]
    wide = nodes.groupBy("tree", "n", F.floor(F.col("pos") / fanout).alias("parent")).agg(*slot)
    row = F.concat_ws("", *[F.col(f"s{i}.digest") for i in range(fanout)])
    return wide.select("tree", F.ceil(F.col("n") / fanout).alias("n"), (F.col("n") > 1).alias("hashed"), F.col("parent").alias("pos"),
                       F.when(F.col("n") > 1, F.sha2(row, 256)).otherwise(F.col("s0.digest")).alias("digest"),
                       F.array_compact(F.array(*[f"s{i}" for i in range(fanout)])).alias("slots")).checkpoint()


def _up(nodes: DataFrame, most: int, fanout: int) -> tuple[list[DataFrame], DataFrame]:
    """(levels from the bottom, last node of every tree) over nodes of trees of at most ``most`` nodes."""
    levels, tops = [], None
    while most > 1:
        single = nodes.where("n = 1").select("tree", "digest")
        tops = single if tops is None else tops.union(single)
        nodes = _gather(nodes.where("n > 1"), fanout)
        levels.append(nodes)
        most = -(-most // fanout)
    last = nodes.select("tree", "digest")
    return levels, last if tops is None else tops.union(last)


def _own_slot(level: DataFrame, above: DataFrame, fanout: int, keep: Sequence[Column] = ()) -> DataFrame:
    """The children of a level: tree, place, slot contents, and the path: siblings left and right, then the parent's path."""
    rows = level.join(above, ["tree", "pos"]).select(
        "tree", (F.col("pos") * fanout).alias("first"), "hashed", "slots", F.transform("slots", lambda s: s["digest"]).alias("digests"), "path", *keep,
        F.posexplode("slots").alias("slot", "item"))
    left = F.concat_ws("", F.slice("digests", 1, F.col("slot")))
    right = F.concat_ws("", F.slice("digests", F.col("slot") + 2, fanout))
    step = F.array(F.struct(left.alias("left"), right.alias("right")))
    return rows.select("tree", (F.col("first") + F.col("slot")).alias("pos"), "item",
                       F.when(F.col("hashed"), F.concat(step, "path")).otherwise(F.col("path")).alias("path"), *[c for c in keep])


def _down(levels: list[DataFrame], above: DataFrame, fanout: int, keep: Sequence[str] = ()) -> DataFrame:
    """Paths (tree, pos, path) of the nodes that ``levels`` were built from; ``above`` has the path of each tree's last node.

    A tree joins at the level where it has one node.
    """
    paths = above.withColumn("pos", F.lit(0).cast("long"))
    for level in reversed(levels):
        from_above = _own_slot(level, paths, fanout, keep).select("tree", "pos", "path", *keep)
        done = paths.join(level.where("pos = 0").select("tree"), "tree", "left_anti")      # trees that ended further down
        paths = from_above.union(done.select("tree", "pos", "path", *keep)).checkpoint()
    return paths


def build_manifest(docs: DataFrame, id_col: str = "doc_id", group_col: str = "source", fields: Sequence[str] = FIELDS,
                   text_col: str = "text", fanout: int = FANOUT) -> DataFrame:
    """Per row: id, leaf, offered (the leaf of a changed row, else null), subroot, root and path.

    ``path`` lists, from the leaf's run up to the root's, the digests left and right of the own one.
    """
    leaves, most, trees = _places(docs, id_col, group_col, fields, text_col)
    bottom = _gather(leaves, fanout, ["row"])
    levels, subroots = _up(bottom.select("tree", "n", "pos", "digest"), -(-most // fanout), fanout)
    subroots = subroots.checkpoint()
    group_nodes = subroots.select(F.lit(0).cast("long").alias("tree"), F.lit(trees).cast("long").alias("n"), F.col("tree").alias("pos"), "digest")
    top_levels, top = _up(group_nodes, trees, fanout)
    root = top.first()
    root_digest = F.lit(root["digest"] if root else None).cast("string")
    start = docs.sparkSession.range(1).select(F.col("id").alias("tree"), F.array().cast(STEP).alias("path"))
    top_paths = _down(top_levels, start, fanout) if trees > 1 else start.withColumn("pos", F.lit(0).cast("long"))
    above = top_paths.select(F.col("pos").alias("tree"), "path").join(subroots.select("tree", F.col("digest").alias("subroot")), "tree")
    paths = _down(levels, above, fanout, ["subroot"])
    return _own_slot(bottom, paths, fanout, ["subroot"]).select(
        F.col("item.row.id").alias(id_col), F.col("item.digest").alias("leaf"), F.col("item.row.offered").alias("offered"), "subroot",
        root_digest.alias("root"), "path")


def proof_digest(path: Column) -> Column:
    """Hash of all siblings, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), ""), 256)


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its siblings lead to."""
    return F.aggregate(path, leaf, lambda d, s: F.sha2(F.concat(s["left"], d, s["right"]), 256))


def verify(docs: DataFrame, id_col: str = "doc_id", group_col: str = "source", fields: Sequence[str] = FIELDS,
           text_col: str = "text", fanout: int = FANOUT) -> DataFrame:
    """Per row: id, leaf, subroot, root, proof_sha256, folded_root (of the row as offered) and whether it equals the root."""
    rows = build_manifest(docs, id_col, group_col, fields, text_col, fanout)
    folded = rows.withColumns({"proof_sha256": proof_digest(F.col("path")), "folded_root": fold(F.coalesce("offered", "leaf"), F.col("path"))})
    return folded.select(id_col, "leaf", "subroot", "root", "proof_sha256", "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))
