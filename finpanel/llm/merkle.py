"""Merkle manifest of a dataset: a tree of digests per group and one tree over the groups.

``H`` is the lowercase hex SHA-256 of its inputs put together, digests as hex text. A row's
leaf is H of its fields, each ``-`` if null, else its UTF-8 byte count, ``:`` and its value.
Within a group (a null group is one, and the first) leaves stand by the order column (null
last; rows alike in it by their leaf, so rows alike in every field are interchangeable);
while several nodes remain, every ``arity`` consecutive ones become their H.

Every level is one equijoin of the nodes with themselves: a node computes the places of its
siblings (its place XOR 1 in a binary tree, else its run's other slots by offset) and tells
them its digest; the join drops places that no node has, and the nodes of slot zero, which
then know their whole run, emit the parents. No group is gathered anywhere: a join key is one
node, and a run has ``arity`` members, however many rows a group holds. Levels are landed, so
a lost executor costs tasks of one level. Paths go down again level by level, and a leaf folds
its own path to the root. SQL functions only.

Columns of the table that are not fields are never read. An empty table has no nodes, no
root and no proofs. Fields may have any type that casts to string.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from finpanel.llm.common import land, run_dir
from finpanel.ml.ranks import row_positions

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def field_text(value: Column) -> Column:
    """A field as it enters a leaf."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(values: Sequence[Column]) -> Column:
    """The leaf of a row with these field values, 32 bytes."""
    return F.unhex(F.sha2(F.concat(*[field_text(v) for v in values]).cast("binary"), 256))


def hex_text(digests: Column) -> Column:
    return F.lower(F.hex(digests))


def parent(digests: Column) -> Column:
    """H of digests that lie one behind the other."""
    return F.unhex(F.sha2(hex_text(digests).cast("binary"), 256))


def sibling_places(place: Column, arity: int) -> Column:
    """The places of the other slots of the run that ``place`` lies in."""
    if arity == 2:
        return F.array(place.bitwiseXOR(F.lit(1).cast("long")))
    slot = F.pmod(place, F.lit(arity))
    return F.array(*[place - slot + F.pmod(slot + o, F.lit(arity)) for o in range(1, arity)])


def with_siblings(nodes: DataFrame, arity: int) -> DataFrame:
    """``nodes`` (tree, place, width, digest, ...) with the digests of the run's nodes ``before``
    and ``after`` each, left to right."""
    told = (nodes.select("tree", "width", F.explode(sibling_places(F.col("place"), arity)).alias("place"),
                         F.struct(F.col("place").alias("at"), "digest").alias("told"))
                 .where("place < width").drop("width"))
    own = [c for c in nodes.columns if c not in ("tree", "place")]
    met = nodes.join(told, ["tree", "place"], "left").groupBy("tree", "place").agg(
        *[F.first(c).alias(c) for c in own], F.array_sort(F.collect_list("told")).alias("run"))

    def digests(keep) -> Column:
        return F.aggregate(F.filter("run", keep), F.lit(b""), lambda acc, x: F.concat(acc, x["digest"]))
    return met.withColumns({"before": digests(lambda x: x["at"] < F.col("place")),
                            "after": digests(lambda x: x["at"] > F.col("place"))}).drop("run")


@dataclass
class Forest:
    """Levels (each tree, place, width, digest, before, after; only nodes that have a parent),
    and the single node that each tree ends in, with the level it stands on."""
    levels: list[DataFrame]
    tops: DataFrame


def climb(nodes: DataFrame, arity: int, path: str) -> Forest:
    """Digests of all levels above ``nodes`` (tree, place, width = nodes of the tree, digest, ...)."""
    widest = nodes.agg(F.max("width")).first()[0] or 0
    levels, tops, extra = [], [], [c for c in nodes.columns if c not in ("tree", "place", "width", "digest")]
    now = nodes
    while True:
        tops.append(now.where("width = 1").select("tree", "digest", F.lit(len(levels)).alias("level"), *extra))
        if widest <= 1:
            break
        level = land(with_siblings(now.where("width > 1"), arity), f"{path}/level-{len(levels)}")
        levels.append(level)
        # Slot zero has nothing before it: its own digest and what stands after it are the run.
        up = level.where(F.pmod("place", F.lit(arity)) == 0)
        now = up.select("tree", F.expr(f"place div {arity}").alias("place"), F.expr(f"(width + {arity - 1}) div {arity}").alias("width"),
                        parent(F.concat("digest", "after")).alias("digest"), *[F.lit(None).cast(nodes.schema[c].dataType).alias(c) for c in extra])
        widest = -(-widest // arity)
    found = tops[0]
    for t in tops[1:]:
        found = found.unionByName(t)
    return Forest(levels, land(found, f"{path}/tops"))


def descend(forest: Forest, above: DataFrame, arity: int, path: str, extra: Sequence[str] = ()) -> DataFrame:
    """Leaves (tree, digest, extra..., path): their siblings on every level, from the leaf up to
    the root, going on with the path that ``above`` (tree, path) has for each tree's top."""
    step = F.array(F.struct("before", "after"))
    tops = forest.tops.join(above, "tree")
    known = tops.where(F.col("level") == len(forest.levels)).select("tree", F.lit(0).cast("long").alias("place"), "digest", *extra, "path")
    for k in reversed(range(len(forest.levels))):
        up = known.select("tree", F.col("place").alias("up"), "path")
        level = forest.levels[k]
        down = level.withColumn("up", F.expr(f"place div {arity}")).join(up, ["tree", "up"]).select(
            "tree", "place", "digest", *extra, F.concat(step, F.col("path")).alias("path"))
        known = down.unionByName(tops.where(F.col("level") == k).select(
            "tree", F.lit(0).cast("long").alias("place"), "digest", *extra, "path"))
        if k:
            known = land(known, f"{path}/path-{k}")
    return known.drop("place")


def fold(path: Column, digest: Column) -> Column:
    """The root that a leaf's digest and its siblings give."""
    return F.aggregate(path, digest, lambda acc, s: parent(F.concat(s["before"], acc, s["after"])))


def siblings_digest(path: Column) -> Column:
    """H of all siblings, level by level, left to right."""
    text = F.array_join(F.transform(path, lambda s: hex_text(F.concat(s["before"], s["after"]))), "")
    return F.sha2(text.cast("binary"), 256)


@dataclass
class Manifest:
    """``root`` (hex; None of an empty table), ``subroots`` (group, width, digest), ``trees``
    and ``crown`` (the levels below and above the subroots) and ``proofs``: a row per row of
    the table with group, leaf, subroot, path and the carried columns."""
    root: str | None
    subroots: DataFrame
    trees: Forest
    crown: Forest
    proofs: DataFrame


def manifest(docs: DataFrame, fields: Sequence[str] = FIELDS, group: str = "lang", order: str = "doc_id", arity: int = 8,
             carry: Mapping[str, Column] | None = None) -> Manifest:
    """Build the trees. ``carry`` are columns computed beside the leaf (of the same row), which
    the proofs hand on, such as the leaf that a changed row would have."""
    if arity < 2:
        raise ValueError("a run has two nodes or more")
    spark, carry = docs.sparkSession, dict(carry or {})
    path = run_dir(spark, "merkle")
    group_text = docs[group].cast("string")
    leaves = land(docs.select(group_text.alias("group"), docs[order].alias("ordered"), leaf_digest([docs[f] for f in fields]).alias("digest"),
                              *[c.alias(f"carry_{n}") for n, c in carry.items()]), f"{path}/leaves")
    extra = [f"carry_{n}" for n in carry]
    placed = row_positions(leaves, ["ordered", "digest"], ["group"], pos="place", total="width")
    groups = leaves.groupBy("group").agg(F.count(F.lit(1)).alias("rows")).withColumn("named", F.col("group").isNotNull())
    trees = land(row_positions(groups, ["named", "group"], pos="tree", total="trees"), f"{path}/trees")
    # A null group is found by its flag and an empty name, so that the join stays an equijoin.
    named = {"named": F.col("group").isNotNull(), "name": F.coalesce("group", F.lit(""))}
    nodes = (placed.withColumns(named).drop("group")
                   .join(trees.withColumns(named).select("named", "name", "tree"), ["named", "name"])
                   .select("tree", F.col("place").cast("long").alias("place"), F.col("width").cast("long").alias("width"), "digest", "ordered", *extra))
    extra = ["ordered", *extra]
    low = climb(nodes, arity, f"{path}/low")
    tops = low.tops.join(trees, "tree")
    crown = climb(tops.select(F.lit(0).cast("long").alias("tree"), F.col("tree").alias("place"), F.col("trees").cast("long").alias("width"), "digest"),
                  arity, f"{path}/high")
    found = crown.tops.first()
    root = found["digest"].hex() if found else None
    start = crown.tops.select("tree", F.array().cast("array<struct<before:binary,after:binary>>").alias("path"))
    ends = descend(Forest([x.withColumn("subtree", F.col("place")) for x in crown.levels],
                          crown.tops.withColumn("subtree", F.lit(0).cast("long"))), start, arity, f"{path}/high", ["subtree"])
    above = land(ends.select(F.col("subtree").alias("tree"), "path"), f"{path}/above")
    subroots = tops.select("tree", "group", F.col("rows").alias("width"), "digest")
    proofs = descend(low, above, arity, f"{path}/low", extra)
    proofs = proofs.join(subroots.select("tree", "group", F.col("digest").alias("subroot")), "tree").select(
        "group", F.col("ordered").alias(order), F.col("digest").alias("leaf"), "subroot", "path", *[F.col(f"carry_{n}").alias(n) for n in carry])
    return Manifest(root, subroots, low, crown, proofs)


def tampered(docs: DataFrame, fields: Sequence[str] = FIELDS, text: str = "text", id_col: str = "doc_id") -> Column:
    """The leaf after tampering: where 3 divides the CRC-32 of the decimal id, A-Z of the text
    are lower-cased (rows without id are left alone)."""
    folded = F.translate(docs[text], "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    chosen = F.coalesce(F.crc32(docs[id_col].cast("string").cast("binary")) % 3 == 0, F.lit(False))
    return leaf_digest([F.when(chosen, folded).otherwise(docs[f]) if f == text else docs[f] for f in fields])


def check_proofs(m: Manifest, leaf: str) -> DataFrame:
    """The proofs with ``folded_root``, made from the column ``leaf``, and whether it is the root."""
    return m.proofs.withColumn("folded_root", hex_text(fold(F.col("path"), F.col(leaf)))).withColumns(
        {"root": F.lit(m.root).cast("string"), "verified": F.col("folded_root") == F.lit(m.root).cast("string")})
