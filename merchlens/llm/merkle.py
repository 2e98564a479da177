"""Merkle manifest of a table: a tree of digests per source, and one over the sources.

A leaf is the digest of a row's fields. Each 16 consecutive nodes become the digest of
their digests, level by level, until one remains. A level is one aggregate over the level
below: conditional aggregates spread the children of a parent into one column per slot.
All slot columns concatenated give what the parent hashes; all but a child's own column
are the child's siblings, those before it to the left and those after it to the right.

Proofs are read off from the top: a parent's row hands each child the parent's own list of
siblings with the child's in front, so upper levels are put together once for 16 children
and no row meets its siblings by a join of its own.

Everything is built-in expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from merchlens.llm.common import documents
from merchlens.session import ensure_checkpoint_dir

FANOUT = 16
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
# Fixed value: one row in so many is tampered with, by the checksum of its doc_id.
TAMPERED_IN = 5

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_SLOTS = [f"slot{at}" for at in range(FANOUT)]


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts), 256)


def field(value: Column) -> Column:
    """A field as its byte count, a colon and its text; '-' if it is null."""
    text = value.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(
        F.concat(F.octet_length(text).cast("string"), F.lit(":"), text)
    )


def leaf_digest(**changed: Column) -> Column:
    """Digest of a row's fields, some of them replaced."""
    return digest(*(field(changed.get(name, F.col(name))) for name in FIELDS))


def numbered(rows: DataFrame, group: str, order: list[str]) -> DataFrame:
    """Add `idx`, the row's place from 0 in its group, and `total`, the group's rows.

    Rows are dealt by ranges of (group, order), so a large group lies in many tasks; a
    row's place is its place in its range and the rows of the group's earlier ranges.
    The last column of `order` has to tell equal rows apart, or a range may be large.
    """
    ranged = rows.repartitionByRange(group, *order)
    dealt = ranged.withColumn("range", F.spark_partition_id()).checkpoint()
    earlier = Window.partitionBy(group).orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        dealt.groupBy(group, "range")
        .agg(F.count(F.lit(1)).alias("held"))
        .select(
            group,
            "range",
            F.coalesce(F.sum("held").over(earlier), F.lit(0)).alias("start"),
            F.sum("held").over(Window.partitionBy(group)).alias("total"),
        )
    )
    within = F.row_number().over(Window.partitionBy(group, "range").orderBy(*order))
    return (
        dealt.withColumn("place", within - 1)
        .join(starts, [group, "range"])
        .withColumn("idx", F.col("start") + F.col("place"))
        .drop("range", "place", "start")
    )


def parents(nodes: DataFrame, kept: tuple[str, ...] = ()) -> DataFrame:
    """The level above: tree, idx, total nodes, and a struct of each child by slot.

    `nodes` has tree, idx, total (nodes of the tree on its level), hash, and the columns
    `kept`, which stay with the child. A tree of one node is done: its row holds that node.
    """
    child = F.struct("hash", *kept)
    slot = F.col("idx") % FANOUT
    return nodes.groupBy(
        "tree", F.floor(F.col("idx") / FANOUT).cast("bigint").alias("idx"), "total"
    ).agg(*(F.max(F.when(slot == at, child)).alias(name) for at, name in enumerate(_SLOTS)))


def as_nodes(level: DataFrame) -> DataFrame:
    """The rows of a level as nodes of the next: all slots of a row hashed."""
    everything = F.sha2(F.concat_ws("", *(F.col(name)["hash"] for name in _SLOTS)), 256)
    return level.select(
        "tree",
        "idx",
        F.ceil(F.col("total") / FANOUT).cast("bigint").alias("total"),
        F.when(F.col("total") > 1, everything).otherwise(F.col(_SLOTS[0])["hash"]).alias("hash"),
    )


def levels_of(nodes: DataFrame, most: int, kept: tuple[str, ...] = ()) -> list[DataFrame]:
    """Levels of trees of at most `most` nodes, from the parents of the leaves to the roots."""
    made = [parents(nodes, kept).checkpoint()]
    while (most := -(-most // FANOUT)) > 1:
        made.append(parents(as_nodes(made[-1])).checkpoint())
    return made


def below(level: DataFrame, *carried: str) -> DataFrame:
    """The children of every row of a level, each with its path to the top.

    `level` has the columns of `parents`, and `path`: the (left, right) siblings of the
    row itself and of its ancestors. A child's own siblings are put in front.
    """

    def siblings(slots: list[str]) -> Column:
        return F.concat_ws("", *(F.col(name)["hash"] for name in slots)) if slots else F.lit("")

    children = []
    for at, name in enumerate(_SLOTS):
        step = F.struct(
            siblings(_SLOTS[:at]).alias("left"), siblings(_SLOTS[at + 1 :]).alias("right")
        )
        children.append(
            F.when(
                F.col(name).isNotNull(),
                F.struct(
                    (F.col("idx") * FANOUT + at).alias("idx"),
                    F.col(name).alias("child"),
                    step.alias("step"),
                ),
            )
        )
    rows = level.select(
        "tree", "total", "path", *carried, F.explode(F.array_compact(F.array(*children))).alias("of")
    )
    # A tree of one node has no step to its root.
    path = F.when(F.col("total") > 1, F.concat(F.array("of.step"), "path")).otherwise(F.col("path"))
    return rows.select("tree", "of.idx", "of.child", path.alias("path"), *carried)


def descended(levels: list[DataFrame], top: DataFrame, *carried: str) -> DataFrame:
    """Leaves of the trees below `top`, with their paths.

    `top` has tree, path and the columns `carried` of each tree's root.
    """
    found = levels[-1].join(top, "tree")
    for level in reversed(levels[:-1]):
        handed = below(found, *carried).select("tree", "idx", "path", *carried)
        found = level.join(handed, ["tree", "idx"])
    return below(found, *carried)


def merkle_manifest(docs: DataFrame) -> DataFrame:
    """Leaf, roots, proof and the check of a tampered copy, for every row of `docs`.

    Returns doc_id, leaf, subroot (of the row's source), root, proof_sha256 (digest of all
    siblings on the way up, left to right), folded_root (the root that the row, or its
    tampered copy, gives with these siblings) and verified. Tampering lower-cases A-Z of
    `text` where 5 divides the CRC-32 of doc_id in decimal.

    Within a source rows stand by doc_id, null first; rows that share it by their leaf, and
    equal rows in any order, as they are the same leaf. A null source is a source, the
    first; null fields count as '-' and empty texts as '0:'. Rows with a null doc_id are
    never tampered with. A source of one row has the leaf as subroot, and a table of one
    source that subroot as root; without any siblings the proof is the digest of nothing.
    An empty table gives no rows. Further columns are ignored.

    Runs jobs while it is built: leaves, and each level, are checkpointed, and the sizes of
    the largest source and of the table of sources decide how many levels there are.
    """
    ensure_checkpoint_dir(docs.sparkSession)
    altered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % TAMPERED_IN == 0
    leaves = docs.select(
        # Null sorts before every source, and joins like any other value.
        F.when(F.col("source").isNull(), F.lit("0"))
        .otherwise(F.concat(F.lit("1"), F.col("source")))
        .alias("tree"),
        "doc_id",
        leaf_digest().alias("hash"),
        F.when(altered, leaf_digest(text=F.translate("text", _UPPER, _LOWER))).alias("tampered"),
        F.monotonically_increasing_id().alias("row"),
    )
    placed = numbered(leaves, "tree", ["doc_id", "hash", "row"]).drop("row")
    most, sources = placed.where("idx = 0").agg(F.max("total"), F.count(F.lit(1))).first()
    levels = levels_of(placed, most or 1, ("doc_id", "tampered"))

    subroots = as_nodes(levels[-1]).select(
        F.lit("").alias("tree"), F.col("tree").alias("of"), "hash"
    )
    ordered = numbered(subroots, "tree", ["of"])
    upper = levels_of(ordered, sources or 1, ("of",))
    nowhere = F.array().cast("array<struct<left:string,right:string>>").alias("path")
    root = as_nodes(upper[-1]).select("tree", F.col("hash").alias("root"), nowhere)
    tops = descended(upper, root, "root").select(
        F.col("child.of").alias("tree"), F.col("child.hash").alias("subroot"), "root", "path"
    )
    rows = descended(levels, tops, "subroot", "root")
    start = F.coalesce(F.col("child.tampered"), F.col("child.hash"))
    folded = F.aggregate("path", start, lambda node, s: digest(s["left"], node, s["right"]))
    proof = F.array_join(F.transform("path", lambda p: F.concat(p["left"], p["right"])), "")
    return rows.select(
        F.col("child.doc_id").alias("doc_id"),
        F.col("child.hash").alias("leaf"),
        "subroot",
        "root",
        F.sha2(proof, 256).alias("proof_sha256"),
        folded.alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


def op12_slot_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Manifest of all documents, one in five of them tampered with."""
    return merkle_manifest(documents(spark, sf_dir))


# Levels that the SQL has; they hold 16^6 nodes a tree.
_SQL_LEVELS = 6


def _oracle() -> str:
    """Levels by ordered string aggregates, proofs by looking up every level by place."""

    def levels(name: str, leaves: str) -> str:
        made = [f"{name}0 AS ({leaves})"]
        for k in range(_SQL_LEVELS):
            made.append(
                f"{name}_run{k} AS (SELECT tree, idx, total,"
                f" coalesce(string_agg(h, '') OVER (PARTITION BY tree, idx // 16 ORDER BY idx"
                f" ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,"
                f" coalesce(string_agg(h, '') OVER (PARTITION BY tree, idx // 16 ORDER BY idx"
                f" ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r FROM {name}{k})"
            )
            made.append(
                f"{name}{k + 1} AS (SELECT tree, idx // 16 AS idx, (total + 15) // 16 AS total,"
                f" CASE WHEN total > 1 THEN sha256(string_agg(h, '' ORDER BY idx)) ELSE min(h) END AS h"
                f" FROM {name}{k} GROUP BY tree, idx // 16, total)"
            )
        return ",\n".join(made)

    def field_sql(value: str) -> str:
        return f"coalesce(octet_length(encode({value}::VARCHAR)) || ':' || {value}, '-')"

    def row(text: str) -> str:
        fields = [text if name == "text" else name for name in FIELDS]
        return "sha256(" + " || ".join(map(field_sql, fields)) + ")"

    steps = [("s", k, "p.idx", "p.tree") for k in range(_SQL_LEVELS)] + [
        ("t", k, "p.place", "''") for k in range(_SQL_LEVELS)
    ]
    joins = "\n".join(
        f"JOIN {name}_run{k} {name}r{k} ON {name}r{k}.tree = {tree}"
        f" AND {name}r{k}.idx = {at} // {FANOUT**k}"
        for name, k, at, tree in steps
    )
    proof = " || ".join(f"{n}r{k}.l || {n}r{k}.r" for n, k, _, _ in steps)
    sides = ", ".join(
        f"{n}r{k}.total AS {n}n{k}, {n}r{k}.l AS {n}l{k}, {n}r{k}.r AS {n}e{k}" for n, k, _, _ in steps
    )
    # Folding step by step in nested selects keeps the text of the query short.
    query = f"""SELECT p.doc_id, p.h AS leaf, u.h AS subroot, w.h AS root,
      coalesce(p.altered, p.h) AS start, sha256({proof}) AS proof_sha256, {sides}
      FROM placed p JOIN s{_SQL_LEVELS} u ON u.tree = p.tree CROSS JOIN t{_SQL_LEVELS} w
      {joins}"""
    for n, k, _, _ in steps:
        query = (
            f"SELECT * REPLACE (CASE WHEN {n}n{k} > 1 THEN sha256({n}l{k} || start || {n}e{k})"
            f" ELSE start END AS start) FROM ({query})"
        )
    return f"""
    WITH crc_table AS (
      SELECT list(c ORDER BY b) AS crc FROM (
        SELECT b, list_reduce(list_prepend(b, range(8)), lambda v, i:
          CASE WHEN v % 2 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END) AS c
        FROM (SELECT unnest(range(256)) AS b))
    ), sums AS (
      SELECT *, xor(list_reduce(list_prepend(4294967295::BIGINT,
          list_transform(regexp_extract_all(hex(encode(doc_id::VARCHAR)), '..'),
            lambda d: ('0x' || d)::BIGINT)),
          lambda v, b: xor(v >> 8, crc[1 + xor(v & 255, b)])), 4294967295::BIGINT)
          % {TAMPERED_IN} = 0 AS chosen
      FROM documents, crc_table
    ), hashed AS (
      SELECT coalesce('1' || source, '0') AS tree, doc_id, {row("text")} AS h,
        CASE WHEN chosen THEN {row(f"translate(text, '{_UPPER}', '{_LOWER}')")} END AS altered
      FROM sums
    ), numbered AS (
      SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, h) - 1 AS idx,
        count(*) OVER (PARTITION BY tree) AS total FROM hashed
    ), {levels("s", "SELECT tree, idx, total, h FROM numbered")},
    subroots AS (
      SELECT '' AS tree, tree AS source, row_number() OVER (ORDER BY encode(tree)) - 1 AS idx,
        count(*) OVER () AS total, h FROM s{_SQL_LEVELS}
    ), {levels("t", "SELECT tree, idx, total, h FROM subroots")},
    placed AS (
      SELECT n.*, b.idx AS place FROM numbered n JOIN subroots b ON b.source = n.tree
    )
    SELECT doc_id, leaf, subroot, root, proof_sha256, start AS folded_root, start = root AS verified
    FROM ({query})"""


ORACLE = _oracle()
