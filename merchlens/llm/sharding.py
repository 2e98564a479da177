"""Shards by a hierarchical weighted hash tree: region, rack, shard.

A row descends the tree. At every node each child draws -ln(u) / weight, where u
comes from a hash of the row's key and the child's name, and the smallest draw
wins, so a child gets rows in proportion to its weight among its siblings. A draw
depends on nothing but key, name and weight:

- a new or heavier child takes rows from its siblings, and none move between them;
- a rack or region whose own weight stays keeps its rows when weights below it
  change, so movement stays inside that subtree.

Everything is built-in expressions; the tree is a literal, as large as the cluster
that it describes and not as the data.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from merchlens.llm.common import documents, running_before
from merchlens.session import ensure_checkpoint_dir

# Bytes that a row takes beside its text.
ROW_BYTES = 16


@dataclass(frozen=True)
class Node:
    """A region, rack or shard. Only shards have a number, only others children."""

    name: str
    weight: float
    children: tuple[Node, ...] = ()
    shard: int | None = None

    def shards(self) -> list[int]:
        own = [] if self.shard is None else [self.shard]
        return own + [n for child in self.children for n in child.shards()]


def uniform_tree(regions: int, racks: int, shards: int) -> Node:
    """Equal weights; shards are numbered from 0 through regions and racks."""
    number = iter(range(regions * racks * shards))

    def rack(name: str) -> Node:
        held = tuple(Node(f"{name}/s{n}", 1.0, (), n) for _, n in zip(range(shards), number))
        return Node(name, float(shards), held)

    return Node(
        "root",
        float(regions * racks * shards),
        tuple(
            Node(
                f"g{g}",
                float(racks * shards),
                tuple(rack(f"g{g}/k{k}") for k in range(racks)),
            )
            for g in range(regions)
        ),
    )


def with_new_shard(tree: Node, weight: float = 1.0) -> Node:
    """One more shard, numbered next, in a region and rack of its own.

    No weight of an existing node changes, so the rows that move all go to the new
    shard. Put into an existing rack it would make that rack and its region heavier,
    and these would share the rows they gain among all their shards.
    """
    number = max(tree.shards()) + 1
    name = f"g-s{number}"
    shard = Node(f"{name}/k0/s{number}", weight, (), number)
    rack = Node(f"{name}/k0", weight, (shard,))
    region = Node(name, weight, (rack,))
    return replace(tree, weight=tree.weight + weight, children=(*tree.children, region))


def with_weight(tree: Node, name: str, weight: float) -> Node:
    """The tree with one node's weight changed and its ancestors' weights kept.

    Rows move only between that node and its siblings, inside their parent.
    """
    if tree.name == name:
        return replace(tree, weight=weight)
    return replace(tree, children=tuple(with_weight(c, name, weight) for c in tree.children))


def tree_shard(key: Column, tree: Node) -> Column:
    """Number of the shard that a key descends to."""
    regions = tree.children
    racks = [rack for region in regions for rack in region.children]
    shards = [shard for rack in racks for shard in rack.children]
    for level in (regions, racks, shards):
        if not any(node.weight > 0 for node in level):
            raise ValueError("every level of the tree needs a positive weight")
    rack_of = _drawn(key, F.lit(0), [regions])
    shard_of = _drawn(key, rack_of, [r.children for r in regions])
    leaf = _drawn(key, shard_of, [k.children for k in racks])
    return F.element_at(F.array(*(F.lit(s.shard) for s in shards)), leaf + 1)


def _drawn(key: Column, parent: Column, families: list[tuple[Node, ...]]) -> Column:
    """Place, among all nodes of a level, of the child drawn below the given parent."""
    place, listed = 0, []
    for family in families:
        members = []
        for node in family:
            members.append(
                F.struct(
                    F.lit(node.name).alias("name"),
                    F.lit(float(node.weight)).alias("weight"),
                    F.lit(place).alias("place"),
                )
            )
            place += 1
        listed.append(F.array(*members))

    def draw(child: Column) -> Column:
        digits = F.substring(F.md5(F.concat(key, F.lit("|"), child["name"])), 1, 13)
        uniform = (F.conv(digits, 16, 10).cast("double") + 0.5) / float(1 << 52)
        score = F.when(child["weight"] > 0, -F.log(uniform) / child["weight"])
        return F.struct(F.coalesce(score, F.lit(float("inf"))).alias("score"), child["place"])

    family = F.element_at(F.array(*listed), parent + 1)
    return F.array_min(F.transform(family, draw))["place"]


def hash_tree_shards(docs: DataFrame, tree: Node, grown: Node | None = None) -> DataFrame:
    """Shard and gapless slot of every document.

    Returns doc_id, size (UTF-8 bytes of the text plus 16), text_crc32, law ('key'),
    shard, slot and grown_shard (the shard in the `grown` tree, null without one). A
    null text counts as empty; rows with a null doc_id share one key; rows with equal
    doc_id share a shard and are numbered by checksum and size; an empty table gives
    no rows. Other columns of `docs` are ignored.

    The text is read once: the few numbers kept of each row are checkpointed, by a job
    while the frame is built, before shards are counted and numbered.
    """
    ensure_checkpoint_dir(docs.sparkSession)
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    text = F.encode(F.coalesce(F.col("text"), F.lit("")), "UTF-8")
    placed = docs.select(
        "doc_id",
        (F.octet_length(text) + F.lit(ROW_BYTES)).cast("bigint").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.lit("key").alias("law"),
        tree_shard(key, tree).alias("shard"),
        (tree_shard(key, grown) if grown else F.lit(None).cast("int")).alias("grown_shard"),
    ).checkpoint()
    numbered = running_before(
        placed, "shard", ["doc_id", "text_crc32", "size"], F.lit(1).cast("bigint"), "slot"
    )
    return numbered.select(
        "doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"
    )


QUERY_TREE = uniform_tree(regions=4, racks=2, shards=5)


def op1_hash_tree_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 40 shards of 4 regions of 2 racks, and in 41."""
    return hash_tree_shards(documents(spark, sf_dir), QUERY_TREE, with_new_shard(QUERY_TREE))


def _level_sql(tree: Node) -> str:
    """DuckDB rows (name, weight, place, parent, level, shard) of a tree."""
    rows = []
    parents = [tree]
    for level in range(3):
        place, below = 0, []
        for at, parent in enumerate(parents):
            for child in parent.children:
                number = "NULL" if child.shard is None else str(child.shard)
                row = f"('{child.name}', {child.weight!r}, {place}, {at}, {level}, {number})"
                rows.append(row)
                below.append(child)
                place += 1
        parents = below
    return "VALUES " + ", ".join(rows)


def _oracle() -> str:
    """Every row descends both trees level by level; the checksum is folded byte by byte."""
    grown = with_new_shard(QUERY_TREE)

    def descent(name: str, tree: Node) -> str:
        score = (
            "-ln((('0x' || md5(key || '|' || n.name)[1:13])::BIGINT::DOUBLE + 0.5)"
            " / 4503599627370496.0) / n.weight"
        )
        steps = [
            f"{name}_nodes(name, weight, place, parent, level, shard) AS ({_level_sql(tree)})",
            f"{name}_at0 AS (SELECT DISTINCT key, 0 AS place FROM keyed)",
        ]
        for level in range(3):
            steps.append(
                f"{name}_at{level + 1} AS (SELECT key, arg_min(n.place, {score}) AS place,"
                f" arg_min(n.shard, {score}) AS shard"
                f" FROM {name}_at{level} a JOIN {name}_nodes n"
                f" ON n.level = {level} AND n.parent = a.place GROUP BY key)"
            )
        return ", ".join(steps)

    return f"""
    WITH keyed AS (
      SELECT doc_id, coalesce(doc_id::VARCHAR, '') AS key, coalesce(text, '') AS body FROM documents
    ), crc_table AS (
      SELECT list(c ORDER BY b) AS crc FROM (
        SELECT b, list_reduce(list_prepend(b, range(8)), lambda v, i:
          CASE WHEN v % 2 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END) AS c
        FROM (SELECT unnest(range(256)) AS b))
    ), bytes AS (
      SELECT *, hex(encode(body)) AS digits FROM keyed
    ), sums AS (
      SELECT doc_id, key, octet_length(encode(body)) + {ROW_BYTES} AS size,
        xor(list_reduce(list_prepend(4294967295::BIGINT,
          list_transform(regexp_extract_all(digits, '..'), lambda d: ('0x' || d)::BIGINT)),
          lambda v, b: xor(v >> 8, crc[1 + xor(v & 255, b)])), 4294967295::BIGINT) AS text_crc32
      FROM bytes, crc_table
    ), {descent("old", QUERY_TREE)}, {descent("new", grown)}
    SELECT doc_id, size, text_crc32, 'key' AS law, o.shard,
      row_number() OVER (PARTITION BY o.shard ORDER BY
        md5(concat_ws('|', key, text_crc32::VARCHAR, size::VARCHAR))[1:3],
        doc_id, text_crc32, size) - 1 AS slot,
      n.shard AS grown_shard
    FROM sums JOIN old_at3 o USING (key) JOIN new_at3 n USING (key)"""


ORACLE = _oracle()
