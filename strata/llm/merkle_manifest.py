"""Merkle manifest of a dataset as a content-addressed graph of records.

A leaf is the digest of a row's fields. Leaves of a group stand in order of
their ids; every ``fan`` consecutive nodes have a parent, up to one node, the
group's top; the groups' tops, in order of the groups, likewise have one root.
The graph is stored as records from a digest to its children, a table for each
height, so equal subtrees are one record.

Proofs come by descent. Requests start at the root as one row and go down by
the digits of their ranks: each step joins the rows with the records on the
digest, opens the children, and puts those that were not taken on the path as
one segment. Leaves under one node share its path until they part, so a step
has as many rows as the tree has nodes there, not as many as there are leaves.
Groups of less height join the descent where their top stands. At the leaves
the segments are reversed, and folding a leaf through them gives the root.

Ranks come from a range partitioning by (group, id): rows are counted by
partition and group, and the counts before a partition are added to the places
within it, so a group with a third of all rows is spread like any other.
Digests are kept as 32 bytes and hashed as lowercase hexadecimal text.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.tables import Scratch

FAN = 3
#: Heights after which the way down is written, so plans do not grow with the tree.
STAGED = 4


def as_hex(digest: Column) -> Column:
    return F.lower(F.hex(digest))


def leaf_digest(*fields: Column) -> Column:
    """Hexadecimal digest of a row: for each field ``-`` if null, else its bytes' number, ``:`` and its value as text."""
    return F.sha2(F.concat(*(F.coalesce(F.concat(F.octet_length(f.cast("string")).cast("string"), F.lit(":"), f.cast("string")), F.lit("-"))
                             for f in fields)), 256)


def parent_digest(children: Column) -> Column:
    return F.unhex(F.sha2(F.array_join(F.transform(children, as_hex), ""), 256))


@dataclass
class Manifest:
    """Tables of a manifest.

    ``leaves``: group key, rank within the group, leaf digest and the columns given along.
    ``groups``: group key, the group's name, its number of leaves, top digest, height and rank among groups.
    ``records``: for the trees of the groups, and for the tree above them, the digest and children by height 1, 2, ...
    """

    leaves: DataFrame
    groups: DataFrame
    records: list[DataFrame]
    above: list[DataFrame]
    root: bytes | None
    fan: int


def _ranked(rows: DataFrame, order: list[str], scratch: Scratch, name: str) -> DataFrame:
    """``rows`` with ``rank`` (from 0) and ``size`` within ``key``, in the given order."""
    placed = (rows.repartitionByRange("key", *order, "_any").withColumn("_part", F.spark_partition_id()))
    placed = scratch.save(placed, f"{name}-placed")
    by_key = Window.partitionBy("key")
    counts = (placed.groupBy("key", "_part").agg(F.count("*").alias("_n"))
              .withColumn("_before", F.coalesce(F.sum("_n").over(by_key.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
              .withColumn("size", F.sum("_n").over(by_key)).drop("_n"))
    inside = F.row_number().over(Window.partitionBy("key", "_part").orderBy(*order, "_any")) - 1
    ranked = placed.withColumn("_place", inside).join(counts, ["key", "_part"])
    return ranked.withColumn("rank", F.col("_before") + F.col("_place")).drop("_part", "_before", "_place", "_any")


def _trees(leaves: DataFrame, fan: int, scratch: Scratch, name: str) -> tuple[list[DataFrame], DataFrame]:
    """Records by height of the trees over ``leaves`` (key, size, rank, digest), and (key, digest, height) of their tops."""
    nodes = leaves.select("key", "size", "rank", "digest")
    tops = nodes.where("size = 1").select("key", "digest", F.lit(0).alias("height"))
    records = []
    largest = leaves.agg(F.max("size")).first()[0] or 0
    while largest > 1:
        own = F.array_sort(F.collect_list(F.struct("rank", "digest")))["digest"]
        up = (nodes.where("size > 1").groupBy("key", F.expr(f"rank div {fan}").alias("rank")).agg(F.max("size").alias("size"), own.alias("children"))
              .select("key", F.expr(f"(size + {fan - 1}) div {fan}").alias("size"), "rank", "children", parent_digest(F.col("children")).alias("digest")))
        nodes = scratch.save(up, f"{name}-{len(records) + 1}")
        records.append(nodes.select("digest", "children"))
        tops = tops.unionByName(nodes.where("size = 1").select("key", "digest", F.lit(len(records)).alias("height")))
        largest = -(-largest // fan)
    return records, tops


def build(docs: DataFrame, digest: Column, id_col: str = "doc_id", group_col: str = "source", keep: dict[str, Column] | None = None,
          fan: int = FAN) -> Manifest:
    """The manifest of ``docs``; ``digest`` is the hexadecimal digest of a row, ``keep`` are columns to carry with the leaves.

    Null groups are a group of their own, before the others; groups follow in
    order of their names' UTF-8 bytes. Ids ascend, null ones first; rows of one id
    stand in order of their digests. Repeated rows are leaves each. An empty
    table has no leaves, no groups and no root. Names of other columns do not matter.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "merkle")
    kept = keep or {}
    group = F.col(group_col).cast("string")
    rows = docs.select(F.coalesce(F.concat(F.lit("="), group), F.lit("")).alias("key"), F.col(id_col).cast("long").alias("id"),
                       F.unhex(digest).alias("digest"), *(c.alias(n) for n, c in kept.items()))
    # equal rows may be parted; a number of their own lets ranges do so
    rows = scratch.save(rows.withColumn("_any", F.monotonically_increasing_id()), "rows")
    leaves = scratch.save(_ranked(rows, ["id", "digest"], scratch, "leaves"), "leaves")
    records, tops = _trees(leaves, fan, scratch, "records")
    name = F.when(F.col("name") != "", F.substring("name", 2, 1 << 30)).alias("name")
    sizes = leaves.where("rank = 0").select("key", F.col("size").alias("n"))
    found = scratch.save(tops.join(sizes, "key").select(F.col("key").alias("name"), "digest", "height", "n", F.lit("").alias("key"), F.lit(0).alias("_any")), "tops")
    groups = scratch.save(_ranked(found, ["name"], scratch, "groups"), "groups")
    above, top = _trees(groups, fan, scratch, "above")
    only = top.first()
    return Manifest(leaves, groups.select(F.col("name").alias("key"), name, "n", "digest", "height", "rank"), records, above,
                    bytes(only["digest"]) if only else None, fan)


def _step(rows: DataFrame, records: DataFrame, fan: int) -> DataFrame:
    """One digit down: ``rows`` (key, rank, digest, path) become a row for each child, with the other children put on the path."""
    opened = (rows.join(records.dropDuplicates(["digest"]), "digest")
              .select("key", "rank", "path", "children", F.posexplode("children").alias("digit", "digest")))
    nothing = F.lit(b"")

    def child(i: int, taken: Column) -> Column:
        return F.when(taken & (F.size("children") > i), F.get("children", F.lit(i))).otherwise(nothing)

    left = F.concat(*(child(i, F.col("digit") > i) for i in range(fan - 1)))
    right = F.concat(*(child(i, F.col("digit") < i) for i in range(1, fan)))
    return opened.select("key", (F.col("rank") * fan + F.col("digit")).alias("rank"), "digest",
                         F.concat("path", F.array(F.struct(left.alias("left"), right.alias("right")))).alias("path"))


def proofs(manifest: Manifest, requests: DataFrame | None = None) -> DataFrame:
    """Leaves with ``path``: from the leaf's run up to the root, the unselected children left and right of the way.

    Each segment has the digests to the left and to the right, joined, 32 bytes
    each. ``requests`` (key, rank) names the leaves wanted; all of them without
    it. Also returns the group's top as ``top``. A request for no leaf gives no row.
    """
    fan, spark = manifest.fan, manifest.leaves.sparkSession
    scratch = Scratch(spark, "merkle-proofs")
    path = "array<struct<left: binary, right: binary>>"
    if manifest.root is None:
        return manifest.leaves.select("*", F.lit(None).cast("binary").alias("top"), F.lit(None).cast(path).alias("path")).limit(0)
    rows = spark.createDataFrame([("", 0, manifest.root, [])], f"key string, rank long, digest binary, path {path}")
    for i, records in enumerate(reversed(manifest.above), 1):
        rows = _step(rows, records, fan)
        if i % STAGED == 0:
            rows = scratch.save(rows, f"above-{i}")
    tops = scratch.save(rows.select("rank", F.col("digest").alias("top"), "path").join(manifest.groups, "rank")
                        .where("top = digest").select("key", "height", "top", "path"), "tops")
    rows = None
    for height in range(len(manifest.records), -1, -1):
        begin = tops.where(F.col("height") == height).select("key", F.lit(0).cast("long").alias("rank"), F.col("top").alias("digest"), "path")
        rows = begin if rows is None else rows.unionByName(begin)
        if requests is not None:  # only prefixes that some request has
            wanted = requests.select("key", F.expr(f"rank div {fan ** height}").alias("rank")).distinct()
            rows = rows.join(wanted, ["key", "rank"], "left_semi")
        if height:
            if height % STAGED == 0:
                rows = scratch.save(rows, f"down-{height}")
            rows = _step(rows, manifest.records[height - 1], fan)
    found = rows.select("key", "rank", F.col("digest").alias("_reached"), F.reverse("path").alias("path"))
    top = manifest.groups.select("key", F.col("digest").alias("top"))
    return manifest.leaves.join(found, ["key", "rank"]).where("_reached = digest").drop("_reached").join(top, "key")


def fold(leaf: Column, path: Column) -> Column:
    """Hexadecimal digest that a leaf's hexadecimal digest and a path lead to."""
    return F.aggregate(path, leaf, lambda up, s: F.sha2(F.concat(as_hex(s["left"]), up, as_hex(s["right"])), 256))


def proof_digest(path: Column) -> Column:
    """Hexadecimal digest of all digests of a path."""
    return F.sha2(F.array_join(F.transform(path, lambda s: F.concat(as_hex(s["left"]), as_hex(s["right"]))), ""), 256)


#: DuckDB SQL of the query ``op13_merkle_manifest``; the checksum is computed bit by bit.
SQL = """
WITH RECURSIVE told AS (
  SELECT *, list_reduce(list_concat([4294967295::BIGINT], flatten(list_transform(string_split(doc_id::VARCHAR, ''),
      lambda c: list_concat([ascii(c)::BIGINT], [-1, -1, -1, -1, -1, -1, -1, -1]::BIGINT[])))),
      lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) ELSE xor(a >> 1, (a & 1) * 3988292384) END) & 1 = 1 AS tampered
  FROM documents),
fields AS (
  SELECT *, coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
      || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') AS most,
    CASE WHEN tampered THEN replace(text, chr(10), '') ELSE text END AS cut
  FROM told),
digests AS (
  SELECT doc_id, coalesce('=' || source, '') AS key, sha256(most || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
    sha256(most || coalesce(strlen(cut) || ':' || cut, '-')) AS other
  FROM fields),
leaves AS (
  SELECT *, row_number() OVER (PARTITION BY key ORDER BY doc_id NULLS FIRST, leaf) - 1 AS rank, count(*) OVER (PARTITION BY key) AS size
  FROM digests),
tree AS (
  SELECT 0 AS height, key, size, rank, leaf AS digest FROM leaves
  UNION ALL
  SELECT height + 1, key, (max(size) + 2) // 3, rank // 3, sha256(string_agg(digest, '' ORDER BY rank))
  FROM tree WHERE size > 1 GROUP BY height, key, rank // 3),
tops AS (
  SELECT key, height AS top_height, digest, row_number() OVER (ORDER BY key) - 1 AS rank, count(*) OVER () AS size FROM tree WHERE size = 1),
above AS (
  SELECT 0 AS height, size, rank, digest FROM tops
  UNION ALL
  SELECT height + 1, (max(size) + 2) // 3, rank // 3, sha256(string_agg(digest, '' ORDER BY rank))
  FROM above WHERE size > 1 GROUP BY height, rank // 3),
segments AS (
  SELECT l.key, l.rank, t.height AS level, t.rank AS place, t.digest, t.rank < l.rank // power(3, t.height)::BIGINT AS is_left
  FROM leaves l JOIN tree t ON t.key = l.key AND t.size > 1 AND t.rank // 3 = l.rank // power(3, t.height + 1)::BIGINT
    AND t.rank <> l.rank // power(3, t.height)::BIGINT
  UNION ALL
  SELECT l.key, l.rank, g.top_height + t.height, t.rank, t.digest, t.rank < g.rank // power(3, t.height)::BIGINT
  FROM leaves l JOIN tops g ON g.key = l.key JOIN above t ON t.size > 1 AND t.rank // 3 = g.rank // power(3, t.height + 1)::BIGINT
    AND t.rank <> g.rank // power(3, t.height)::BIGINT),
paths AS (
  SELECT key, rank, level, coalesce(string_agg(digest, '' ORDER BY place) FILTER (is_left), '') AS before,
    coalesce(string_agg(digest, '' ORDER BY place) FILTER (NOT is_left), '') AS after
  FROM segments GROUP BY key, rank, level),
folded AS (
  SELECT key, rank, 0 AS level, other AS digest FROM leaves
  UNION ALL
  SELECT f.key, f.rank, f.level + 1, sha256(coalesce(p.before, '') || f.digest || coalesce(p.after, ''))
  FROM folded f JOIN tops g ON g.key = f.key LEFT JOIN paths p ON p.key = f.key AND p.rank = f.rank AND p.level = f.level
  WHERE f.level < g.top_height + (SELECT max(height) FROM above)),
proofs AS (SELECT key, rank, string_agg(before || after, '' ORDER BY level) AS proof FROM paths GROUP BY key, rank)
SELECT l.doc_id, l.leaf, g.digest AS subroot, r.digest AS root, sha256(coalesce(p.proof, '')) AS proof_sha256,
  f.digest AS folded_root, f.digest = r.digest AS verified
FROM leaves l JOIN tops g ON g.key = l.key JOIN (SELECT digest FROM above WHERE size = 1) r ON true
JOIN folded f ON f.key = l.key AND f.rank = l.rank AND f.level = g.top_height + (SELECT max(height) FROM above)
LEFT JOIN proofs p ON p.key = l.key AND p.rank = l.rank
"""
