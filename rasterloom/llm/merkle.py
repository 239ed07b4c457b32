"""Merkle dataset manifest: a tree over each group's rows, a tree over the groups' roots, and every row's proof.

Rows are ranked by range, so no task holds a group. Each aligned block of 4,096 digests is one task's work: its root
first; then the same again over the blocks' roots until one is left; then, with the proofs of the blocks at hand, a
fractal traversal of each block emits its leaves' paths one after the other. For each of its stacked levels it keeps the
subtree in use ("existing") and grows the one to its right ("desired") by one leaf a step, so it holds two small subtrees
a level whatever the block's size.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rasterloom.llm.common import needs, placed, stored

HEIGHT = 12  # a block has 2 ** HEIGHT leaves
STACKED = 3  # levels of one subtree of the traversal
PATH = "array<struct<left: boolean, digest: string>>"
_STEP = pa.struct([("left", pa.bool_()), ("digest", pa.string())])


def digest_of(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


class _Grower:
    """Builds the subtree over leaves [start, start + 2 ** top) of a tree of n leaves, one leaf a step.

    Keeps the nodes of levels low to top - 1 and, besides, a stack of at most one node a level. A node without a right
    neighbour at its level is hashed alone.
    """

    def __init__(self, leaves: list[str], start: int, low: int, top: int):
        self.leaves, self.low, self.top = leaves, low, top
        self.next, self.end = start, min(start + (1 << top), len(leaves))
        self.nodes: dict[tuple[int, int], str] = {}
        self.waiting: dict[int, str] = {}
        self.root: str | None = None

    def step(self) -> None:
        if self.next >= self.end:
            return
        level, at, node = 0, self.next, self.leaves[self.next]
        self.next += 1
        while True:
            if level == self.top:
                self.root = node
                return
            if level >= self.low:
                self.nodes[level, at] = node
            if at & 1:
                node = digest_of(self.waiting.pop(level), node)
            elif at == (len(self.leaves) - 1) >> level:
                node = digest_of(node)
            else:
                self.waiting[level] = node
                return
            level, at = level + 1, at >> 1

    def finish(self) -> _Grower:
        while self.next < self.end:
            self.step()
        return self


def height_of(n: int) -> int:
    """Levels between n leaves and their root."""
    return max(n - 1, 0).bit_length()


def block_root(leaves: list[str], height: int) -> str:
    return _Grower(leaves, 0, height, height).finish().root


def fractal_paths(leaves: list[str], height: int) -> Iterator[list[tuple[bool, str]]]:
    """The authentication path of each leaf, from the left: (sibling is on the left, sibling or "" where there is none)."""
    tops = [min(low + STACKED, height) for low in range(0, height, STACKED)]
    lows = list(range(0, height, STACKED))
    existing = [_Grower(leaves, 0, low, top).finish() for low, top in zip(lows, tops, strict=True)]
    desired = [_Grower(leaves, 1 << top, low, top) for low, top in zip(lows, tops, strict=True)]
    for k in range(len(leaves)):
        path = []
        for level in range(height):
            sibling = k >> level ^ 1
            path.append((bool(k >> level & 1), existing[level // STACKED].nodes.get((level, sibling), "")))
        yield path
        for i, top in enumerate(tops):
            desired[i].step()
            if not (k + 1) & ((1 << top) - 1):
                existing[i] = desired[i].finish()
                desired[i] = _Grower(leaves, k + 1 + (1 << top), lows[i], top)


def _block_height(size: int, height: int) -> int:
    return min(height, height_of(size))


def _roots_of(rows: DataFrame, height: int) -> DataFrame:
    """(tree, rank, size, digest) of the blocks of (tree, rank, size, digest), numbered from 0 in each tree."""
    def of(key: tuple, block: pa.Table) -> pa.Table:
        rank, leaves = block["rank"].to_pylist(), block["digest"].to_pylist()
        size = block["size"][0].as_py()
        ordered = [leaves[i] for i in sorted(range(len(rank)), key=rank.__getitem__)]
        return pa.table({
            "tree": pa.array([key[0].as_py()], pa.string()),
            "rank": pa.array([key[1].as_py()], pa.int64()),
            "size": pa.array([(size - 1 >> height) + 1], pa.int64()),
            "digest": pa.array([block_root(ordered, _block_height(size, height))], pa.string()),
        })

    narrow = rows.select("tree", "rank", "size", "digest", F.shiftright("rank", height).alias("block"))
    return narrow.groupBy("tree", "block").applyInArrow(of, "tree string, rank long, size long, digest string")


def _with_paths(rows: DataFrame, above: DataFrame, height: int) -> DataFrame:
    """rows with path and root: each block is traversed, and the path of its root, from ``above``, is appended.

    ``above`` has a row (tree, rank, path, root) for each block; rows of rank, digest and size may have more columns.
    """
    kind = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)

    def of(key: tuple, block: pa.Table, upper: pa.Table) -> pa.Table:
        block = block.drop_columns(["block_"]).sort_by("rank")
        tail = [(s["left"], s["digest"]) for s in upper["path"][0].as_py()]
        left, digest, ends = [], [], [0]
        for path in fractal_paths(block["digest"].to_pylist(), _block_height(block["size"][0].as_py(), height)):
            for on_left, sibling in path + tail:
                left.append(on_left)
                digest.append(sibling)
            ends.append(len(left))
        steps = pa.StructArray.from_arrays([pa.array(left, pa.bool_()), pa.array(digest, pa.string())], fields=list(_STEP))
        paths = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), steps)
        block = block.append_column("path", paths)
        return block.append_column("root", pa.array([upper["root"][0].as_py()] * len(block), pa.string()))

    dealt = rows.withColumn("block_", F.shiftright("rank", height))
    upper = above.select("tree", F.col("rank").alias("block_"), "path", "root")
    return dealt.groupBy("tree", "block_").cogroup(upper.groupBy("tree", "block_")).applyInArrow(of, f"{kind}, path {PATH}, root string")


def _above(rows: DataFrame, height: int) -> DataFrame:
    """(tree, rank, path, root) for each block of rows: where its root lies below its tree's root."""
    roots = stored(_roots_of(rows, height), "block-roots")
    if (roots.agg(F.max("size")).first()[0] or 1) == 1:
        return roots.select("tree", "rank", F.expr(f"CAST(array() AS {PATH})").alias("path"), F.col("digest").alias("root"))
    return stored(_with_paths(roots, _above(roots, height), height).select("tree", "rank", "path", "root"), "block-paths")


def field(value: Column) -> Column:
    """A field in a leaf: "-" for null, else its length in bytes, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_of(*values: Column) -> Column:
    return F.sha2(F.concat(*map(field, values)), 256)


def merkle_manifest(docs: DataFrame, fields: list[str], group: str = "lang", order: str = "doc_id", carry: dict[str, Column] | None = None, height: int = HEIGHT) -> DataFrame:
    """The manifest of docs: a row for each with order, group, position (in its group), leaf, path, subroot and root.

    A leaf is the digest of its ``fields``. Each group's leaves ascend by ``order``, and groups by their UTF-8 bytes, a
    null one first; two neighbours become their digest until one is left, a last one without a neighbour is hashed
    alone. ``path`` lists, from the leaf to the root of all, the sibling at each level (side and digest, "" where there
    is none). ``carry`` adds columns of docs by name.

    Nulls: a null field is "-", a null group is a group, null orders come first. Ties and repeated rows: each is a leaf;
    rows of one order ascend by leaf, so equal tables have equal roots. Long texts are hashed whole. An empty table has
    an empty manifest and so no root. Memory: a task holds a block of 2 ** height leaves; nothing but the number of levels
    reaches the driver. Other columns of docs don't reach the manifest, so clashing names can't meet.
    """
    needs(docs, *fields, group, order)
    carry = carry or {}
    if clash := {"tree", "rank", "size", "digest", "path", "root", "block_", "subroot", "position", group, order} & set(carry):
        raise ValueError(f"names in use: {sorted(clash)}")
    leaves = docs.select(
        F.col(order).alias("order_"), F.col(group).alias("group_"), field(F.col(group)).alias("tree"),
        leaf_of(*map(F.col, fields)).alias("digest"), *[c.alias(n) for n, c in carry.items()],
    )
    leaves = placed(stored(leaves, "leaves"), ["tree"], ["order_", "digest"], rank="rank", total="size")
    above = _above(leaves, height)
    tops = above.filter("rank = 0").select(F.col("tree").alias("of"), F.col("root").alias("digest"))
    names = stored(tops.join(leaves.filter("rank = 0").select(F.col("tree").alias("of"), "group_"), "of"), "subroots")
    tops = placed(names.withColumn("tree", F.lit("top")), ["tree"], ["group_"], rank="rank", total="size")
    tops = _with_paths(tops, _above(tops, height), height).select(F.col("of").alias("tree"), F.col("path").alias("over"), F.col("root").alias("whole"))
    joined = above.join(stored(tops, "group-paths"), "tree")
    #: Both roots travel in one column through the traversal of the blocks.
    both = joined.select("tree", "rank", F.concat("path", "over").alias("path"), F.concat_ws(" ", "root", "whole").alias("root"))
    out = _with_paths(leaves, stored(both, "upper-paths"), height)
    at = F.split("root", " ")
    return out.select(
        F.col("order_").alias(order), F.col("group_").alias(group), F.col("rank").alias("position"), F.col("digest").alias("leaf"),
        "path", at[0].alias("subroot"), at[1].alias("root"), *carry,
    )


def proof_digest(path: Column) -> Column:
    """One digest of all siblings of a path, from the leaf up."""
    return F.sha2(F.array_join(F.transform(path, lambda s: s["digest"]), ""), 256)


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and the siblings of its path give."""
    def up(node: Column, sibling: Column) -> Column:
        other = sibling["digest"]
        return F.sha2(F.when(sibling["left"], F.concat(other, node)).otherwise(F.concat(node, other)), 256)

    return F.aggregate(path, leaf, up)


FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]


def proven(docs: DataFrame, height: int = HEIGHT) -> DataFrame:
    """The digests of the manifest of docs, and whether each one's proof still leads to the root once it was tampered with.

    Where 7 divides the checksum of its doc_id a document is tampered with: n_chars grows by 1. A null doc_id has no
    checksum and is left alone, and a null n_chars stays null, so such documents verify.
    """
    hit = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 7 == 0, F.lit(False)) & F.col("n_chars").isNotNull()
    forged = leaf_of(*[F.col(c) + 1 if c == "n_chars" else F.col(c) for c in FIELDS])
    rows = merkle_manifest(docs, FIELDS, carry={"forged": F.when(hit, forged)}, height=height)
    end = folded(F.coalesce("forged", "leaf"), F.col("path"))
    rows = rows.select("doc_id", "leaf", "subroot", "root", proof_digest(F.col("path")).alias("proof_sha256"), end.alias("folded_root"))
    return rows.withColumn("verified", F.col("folded_root") == F.col("root"))


def op12_query(spark, sf_dir: str) -> DataFrame:
    return proven(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def _sql_field(value: str) -> str:
    return f"coalesce(strlen(CAST({value} AS VARCHAR)) || ':' || CAST({value} AS VARCHAR), '-')"


def op12_sql() -> str:
    """DuckDB SQL for op12: levels of both trees by recursion, then every leaf's way up. It has no crc32, so that's a fold over bits."""
    def leaf(more: str = "") -> str:
        return "sha256(" + " || ".join(_sql_field(c + more if c == "n_chars" else c) for c in FIELDS) + ")"

    digits = "list_transform(regexp_split_to_array(CAST(doc_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))"
    bit = "xor(a >> 1, CASE WHEN a & 1 = 1 THEN 3988292384 ELSE 0 END)"
    byte = f"list_reduce(list_prepend(xor(c, b), [1::BIGINT, 2, 3, 4, 5, 6, 7, 8]), lambda a, n: {bit})"
    crc = f"xor(list_reduce(list_prepend(4294967295::BIGINT, {digits}), lambda c, b: {byte}), 4294967295)"

    def levels(name: str, start: str) -> str:
        return f"""{name}(tree, level, i, h) AS (
  SELECT tree, 0, i, h FROM {start}
  UNION ALL
  SELECT tree, level + 1, i // 2, sha256(string_agg(h, '' ORDER BY i))
  FROM (SELECT *, count(*) OVER (PARTITION BY tree) AS c FROM {name}) WHERE c > 1 GROUP BY tree, level, i // 2)"""

    def climb(name: str, nodes: str, start: str) -> str:
        return f"""{name}(k, tree, level, i, h, proof) AS (
  SELECT k, tree, 0, i, h, proof FROM {start}
  UNION ALL
  SELECT u.k, u.tree, u.level + 1, u.i // 2,
    sha256(CASE WHEN u.i % 2 = 1 THEN coalesce(s.h, '') || u.h ELSE u.h || coalesce(s.h, '') END), u.proof || coalesce(s.h, '')
  FROM {name} u JOIN (SELECT tree, max(level) AS height FROM {nodes} GROUP BY tree) t ON t.tree = u.tree
  LEFT JOIN {nodes} s ON s.tree = u.tree AND s.level = u.level AND s.i = xor(u.i, 1)
  WHERE u.level < t.height)"""

    return f"""WITH RECURSIVE facts AS (
  SELECT row_number() OVER () AS k, doc_id, lang, {_sql_field("lang")} AS tree, {leaf()} AS h,
    CASE WHEN {crc} % 7 = 0 AND doc_id IS NOT NULL AND n_chars IS NOT NULL THEN {leaf(" + 1")} END AS forged
  FROM documents),
leaves AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, h) - 1 AS i FROM facts),
{levels("nodes", "leaves")},
subroots AS (SELECT tree, arg_max(h, level) AS h FROM nodes GROUP BY tree),
langs AS (
  SELECT 'top' AS tree, s.tree AS name, s.h, row_number() OVER (ORDER BY l.lang NULLS FIRST) - 1 AS i
  FROM subroots s JOIN (SELECT DISTINCT tree, lang FROM leaves) l ON l.tree = s.tree),
{levels("tops", "langs")},
{climb("inner_way", "nodes", "(SELECT k, tree, i, coalesce(forged, h) AS h, '' AS proof FROM leaves)")},
half AS (
  SELECT w.k, 'top' AS tree, l.i, w.h, w.proof FROM inner_way w JOIN langs l ON l.name = w.tree
  JOIN (SELECT tree, max(level) AS height FROM nodes GROUP BY tree) t ON t.tree = w.tree AND t.height = w.level),
{climb("outer_way", "tops", "half")},
whole AS (SELECT k, arg_max(h, level) AS h, arg_max(proof, level) AS proof FROM outer_way GROUP BY k),
root AS (SELECT arg_max(h, level) AS h FROM tops)
SELECT l.doc_id, l.h AS leaf, s.h AS subroot, root.h AS root, sha256(w.proof) AS proof_sha256, w.h AS folded_root, w.h = root.h AS verified
FROM leaves l JOIN whole w ON w.k = l.k JOIN subroots s ON s.tree = l.tree, root"""
