"""A Merkle manifest of a dataset, kept as a postorder append log.

Leaves stand in order per language; every two neighbours, or a last one alone, become their parent
until one node, the subroot, is left. The subroots become the root in the same way.

The tree is built in tiers of ``HEIGHT`` levels. In a tier, aligned builders take 2**HEIGHT
consecutive nodes each and append the nodes of their subtree to a log in the order in which they are
completed: a parent right after its last child. A builder's part of the log is one row (tier, key,
block, nodes). Where a node stands in it follows from the sizes of the subtrees before it, in closed
form (``postorder``), so the siblings on a leaf's way up are read by position without an index.
What the builders hand on are the leaves of the next tier, until every tree has one node.

Proofs are extracted from the top down: a builder's row is joined with the way from its own root to
the top, and gives each of its leaves the siblings from its log followed by that way.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.positions import add_positions
from ..session import cut
from .tables import ship, table

#: Levels of one tier; a builder takes 2**HEIGHT nodes.
HEIGHT = 10
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: One level of a way up: the node has no sibling, one to its left, or one to its right.
ALONE, LEFT, RIGHT = 0, 1, 2
STEP = 33


def subtree_size(level: int, leaves: int) -> int:
    """Nodes of a subtree that reaches up to ``level`` over its first ``leaves`` leaves."""
    return sum(-(-leaves >> j) for j in range(level + 1))


def postorder(level: int, index: int, leaves: int) -> int:
    """The position of node ``index`` of ``level`` in the log of a tree of ``leaves`` leaves: all
    nodes that end before its first leaf s, which are 2s - popcount(s), then its own subtree."""
    s = index << level
    return 2 * s - s.bit_count() + subtree_size(level, min(1 << level, leaves - s)) - 1


def height(leaves: int) -> int:
    """Levels above the leaves until one node is left."""
    return (leaves - 1).bit_length()


def digest(*parts: bytes) -> bytes:
    """H over digests, which go in as hex text."""
    return hashlib.sha256("".join(p.hex() for p in parts).encode()).digest()


def append_log(leaves: Sequence[bytes], top: int) -> bytes:
    """One builder's log up to level ``top``: each leaf, followed by all nodes it completes."""
    log: list[bytes] = []
    open_nodes: list[list[bytes]] = [[] for _ in range(top + 1)]
    last = len(leaves) - 1
    for i, leaf in enumerate(leaves):
        node, level = leaf, 0
        log.append(node)
        while level < top:
            pair = open_nodes[level]
            pair.append(node)
            if len(pair) == 1 and i != last:
                break
            node = digest(*pair)
            pair.clear()
            level += 1
            log.append(node)
    return b"".join(log)


def ways(log: bytes, leaves: int, top: int) -> list[bytes]:
    """Per leaf the way to the node at level ``top``: STEP bytes a level, the kind and the sibling."""
    positions = [[postorder(level, i, leaves) * 32 for i in range(-(-leaves >> level))] for level in range(top)]
    above: list[bytes] = [b""]
    for level in range(top - 1, -1, -1):
        at, below = positions[level], []
        for i in range(len(at)):
            if i ^ 1 < len(at):
                p = at[i ^ 1]
                step = bytes([LEFT if i & 1 else RIGHT]) + log[p : p + 32]
            else:
                step = bytes(STEP)
            below.append(step + above[i >> 1])
        above = below
    return above


def fold(leaf: bytes, way: bytes) -> bytes:
    """The root that follows from a leaf and its way up."""
    node = leaf.hex()
    for at in range(0, len(way), STEP):
        kind = way[at]
        if kind == LEFT:
            node = way[at + 1 : at + STEP].hex() + node
        elif kind == RIGHT:
            node += way[at + 1 : at + STEP].hex()
        node = hashlib.sha256(node.encode()).hexdigest()
    return bytes.fromhex(node)


def proof_digest(way: bytes) -> bytes:
    """H of the siblings of a way, from the leaf's up."""
    return digest(*[way[at + 1 : at + STEP] for at in range(0, len(way), STEP) if way[at] != ALONE])


def leaf_digest(fields: Sequence[Column]) -> Column:
    """H of a row's fields: ``-`` for null, else the bytes' number, ``:`` and the value."""
    value = [c.cast("string") for c in fields]
    coded = [F.coalesce(F.concat(F.octet_length(v).cast("string"), F.lit(":"), v), F.lit("-")) for v in value]
    return F.unhex(F.sha2(F.concat(*coded), 256))


def tree_key(lang: Column) -> Column:
    """A text that sorts null first, then bytewise, and is never null."""
    return F.when(lang.isNull(), F.lit("")).otherwise(F.concat(F.lit("="), lang.cast("string")))


LOG = "tree string, block long, total long, leaves int, top int, nodes binary, root binary"
LEAF = "struct<doc_id:long,changed:binary>"
WAY = "tree string, at long, way binary"


def _build(levels: int):
    """An aligned builder: the consecutive nodes of one block become one row of the log."""

    def run(block: pa.Table) -> pa.Table:
        block = block.take(pa.array(np.argsort(np.asarray(block["at"]))))
        total, leaves = block["total"][0].as_py(), block["node"].to_pylist()
        top = min(levels, height(total))
        log = append_log(leaves, top)
        kinds = block.schema.field("row").type
        return pa.table({
            "tree": pa.array([block["tree"][0].as_py()], pa.string()), "block": pa.array([block["at"][0].as_py() >> levels], pa.int64()),
            "total": pa.array([total], pa.int64()), "leaves": pa.array([len(leaves)], pa.int32()), "top": pa.array([top], pa.int32()),
            "nodes": pa.array([log], pa.binary()), "root": pa.array([log[-32:]], pa.binary()), "rows": pa.array([block["row"].to_pylist()], pa.list_(kinds)),
        })

    return run


def _ways_down(levels: int):
    def run(batches):
        for b in batches:
            out = {"tree": [], "at": [], "way": []}
            for tree, block, leaves, top, nodes, way in zip(*[b.column(n).to_pylist() for n in ("tree", "block", "leaves", "top", "nodes", "way")]):
                for i, own in enumerate(ways(nodes, leaves, top)):
                    out["tree"].append(tree)
                    out["at"].append((block << levels) + i)
                    out["way"].append(own + way)
            yield pa.RecordBatch.from_arrays(
                [pa.array(out["tree"], pa.string()), pa.array(out["at"], pa.int64()), pa.array(out["way"], pa.binary())], names=["tree", "at", "way"]
            )

    return run


def _prove(levels: int):
    def run(batches):
        names = [c.split()[0] for c in PROVED.split(", ")]
        kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.string(), pa.bool_()]
        for b in batches:
            for k in range(len(b)):
                row = {n: b.column(n)[k].as_py() for n in b.schema.names}
                nodes, leaves, root, first = row["nodes"], row["leaves"], row["root"], row["block"] << levels
                out = []
                for i, (own, leaf_row) in enumerate(zip(ways(nodes, leaves, row["top"]), row["rows"])):
                    way = own + row["way"]
                    at = postorder(0, i, leaves) * 32
                    leaf = nodes[at : at + 32]
                    folded = fold(leaf if leaf_row["changed"] is None else leaf_row["changed"], way)
                    out.append((leaf_row["doc_id"], leaf.hex(), first + i, row["subroot"].hex(), root.hex(), proof_digest(way).hex(), folded.hex(), folded == root))
                yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(zip(*out), kinds)], names=names)

    return run


PROVED = "doc_id long, leaf string, leaf_index long, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"


class Manifest:
    """The logs of a dataset: tiers over the leaves of each language, and tiers over the subroots."""

    def __init__(self, docs: DataFrame, tampered: Column | None = None, levels: int = HEIGHT):
        """``tampered``: rows whose n_chars a later check finds one higher. ``levels`` of a tier.

        Leaves ascend by doc_id, null first; rows with one doc_id by their digest, so the order of
        equal ids doesn't depend on the input's; repeated rows are leaves of their own. A null in
        any field goes into the digest as ``-``. Columns other than the five are not read. A table
        without rows has no trees and no root.
        """
        ship(docs.sparkSession)
        self.levels = levels
        later = [(F.col("n_chars").cast("decimal(20,0)") + 1) if c == "n_chars" else F.col(c) for c in FIELDS]
        touched = F.lit(False) if tampered is None else F.coalesce(tampered, F.lit(False)) & F.col("n_chars").isNotNull()
        coded = cut(docs.select(
            tree_key(F.col("lang")).alias("tree"), F.col("doc_id").cast("long").alias("doc_id"), leaf_digest([F.col(c) for c in FIELDS]).alias("node"),
            F.when(touched, leaf_digest(later)).alias("changed"), F.xxhash64(F.monotonically_increasing_id()).alias("salt"),
        ))
        # the salt parts rows that are equal in everything, so that many copies don't meet in one task
        placed = add_positions(coded, ["tree", "doc_id", "node", "salt"], "place")
        trees = cut(placed.groupBy("tree").agg(F.min("place").alias("first"), F.count("*").alias("total")))
        self.tiers = self._tiers(placed.join(trees, "tree").select(
            "tree", (F.col("place") - F.col("first")).alias("at"), "total", "node", F.struct("doc_id", "changed").alias("row")
        ), LEAF)
        subroots = cut(self._roots(self.tiers))
        count = subroots.count()
        ordered = add_positions(subroots, ["tree"], "at")
        self.top_tiers = self._tiers(ordered.select(
            F.lit("").alias("tree"), "at", F.lit(count).cast("long").alias("total"), F.col("root").alias("node"), F.struct(F.col("tree").alias("of")).alias("row")
        ), "struct<of:string>")
        self.root = self._roots(self.top_tiers).select("root")

    def _higher(self) -> Column:
        """Whether a tree goes on above this tier."""
        return F.col("total") > (1 << self.levels)

    def _tier(self, nodes: DataFrame, row: str) -> DataFrame:
        """The log of one tier over (tree, at, total, node, row), written to the shared folder."""
        blocks = nodes.groupBy("tree", F.shiftright("at", self.levels).alias("block"))
        return cut(blocks.applyInArrow(_build(self.levels), f"{LOG}, rows array<{row}>"))

    def _tiers(self, nodes: DataFrame, row: str) -> list[DataFrame]:
        """Logs from these nodes up to one node per tree; a tier's blocks are the next one's leaves."""
        logs = [self._tier(nodes, row)]
        while logs[-1].where(self._higher()).limit(1).count():
            logs.append(self._tier(logs[-1].where(self._higher()).select(
                "tree", F.col("block").alias("at"), F.shiftright(F.col("total") + ((1 << self.levels) - 1), self.levels).alias("total"),
                F.col("root").alias("node"), F.struct(F.lit(None).cast("int").alias("none")).alias("row"),
            ), "struct<none:int>"))
        return logs

    def _roots(self, logs: list[DataFrame]) -> DataFrame:
        """(tree, root) of all trees, each from the tier that it ends in."""
        return reduce(DataFrame.unionByName, [log.where(~self._higher()).select("tree", "root") for log in logs])

    def _ways(self, log: DataFrame) -> DataFrame:
        return log.select("tree", "block", "leaves", "top", "nodes", "way").mapInArrow(_ways_down(self.levels), WAY)

    def _down(self, logs: list[DataFrame], tops: DataFrame) -> DataFrame:
        """The lowest tier's rows with the way from their own root to the very top: trees that end
        in a tier take it from ``tops``, the others from the tier above."""
        rows = None
        for log in reversed(logs):
            ended = log.where(~self._higher()).join(tops, "tree")
            if rows is not None:
                inner = log.where(self._higher()).join(self._ways(rows).withColumnRenamed("at", "block"), ["tree", "block"])
                ended = ended.unionByName(inner.select(*ended.columns))
            rows = ended
        return rows

    def proofs(self) -> DataFrame:
        """Every leaf with its proof, folded up and held against the root: PROVED."""
        start = self.root.select(F.lit("").alias("tree"), F.lit(b"").alias("way"))
        above = self._ways(self._down(self.top_tiers, start)).select("at", "way")
        names = self.top_tiers[0].select("block", F.posexplode("rows").alias("i", "r")).select(
            (F.shiftleft("block", self.levels) + F.col("i")).alias("at"), F.col("r.of").alias("tree")
        )
        rows = self._down(self.tiers, names.join(above, "at").select("tree", "way")).drop("root")
        subroots = self._roots(self.tiers).withColumnRenamed("root", "subroot")
        return rows.join(subroots, "tree").crossJoin(F.broadcast(self.root)).mapInArrow(_prove(self.levels), PROVED)  # one root


NAME = "op11_merkle_manifest"
SQL = """
WITH RECURSIVE c AS (
  SELECT doc_id, lang, coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-') || coalesce(strlen(lang) || ':' || lang, '-') AS a,
         n_chars, coalesce(strlen(text) || ':' || text, '-') AS z,
         xor(4294967295, list_reduce(list_concat([4294967295], [CAST(ord(substr(CAST(doc_id AS VARCHAR), CAST(j AS INTEGER), 1)) AS BIGINT) FOR j IN range(1, strlen(CAST(doc_id AS VARCHAR)) + 1)]),
           lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: xor(x >> 1, 3988292384 * (x & 1))))) % 7 = 0 AS hit
  FROM documents
), l AS (
  SELECT doc_id, coalesce('=' || lang, '') AS k, sha256(a || coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-') || z) AS leaf,
         sha256(a || coalesce(strlen(CAST(n_chars + CASE WHEN hit THEN 1 ELSE 0 END AS VARCHAR)) || ':' || (n_chars + CASE WHEN hit THEN 1 ELSE 0 END), '-') || z) AS seen
  FROM c
), d AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY k ORDER BY doc_id NULLS FIRST, leaf) - 1 AS BIGINT) AS pos, CAST(count(*) OVER (PARTITION BY k) AS BIGINT) AS n FROM l
), t(k, level, pos, h, n) AS (
  SELECT k, CAST(0 AS BIGINT), pos, leaf, n FROM d
  UNION ALL
  SELECT k, level + 1, pos // 2, sha256(string_agg(h, '' ORDER BY pos)), (n + 1) // 2 FROM t WHERE n > 1 GROUP BY k, level, pos // 2, n
), s AS (
  SELECT k, h, CAST(row_number() OVER (ORDER BY encode(k)) - 1 AS BIGINT) AS pos, CAST(count(*) OVER () AS BIGINT) AS n FROM t WHERE n = 1
), u(level, pos, h, n) AS (
  SELECT CAST(0 AS BIGINT), pos, h, n FROM s
  UNION ALL
  SELECT level + 1, pos // 2, sha256(string_agg(h, '' ORDER BY pos)), (n + 1) // 2 FROM u WHERE n > 1 GROUP BY level, pos // 2, n
), w(k, own, level, pos, h, proof, n) AS (
  SELECT k, pos, CAST(0 AS BIGINT), pos, seen, '', n FROM d
  UNION ALL
  SELECT w.k, w.own, w.level + 1, w.pos // 2,
         sha256(CASE WHEN w.pos % 2 = 1 THEN t.h || w.h ELSE w.h || coalesce(t.h, '') END), w.proof || coalesce(t.h, ''), (w.n + 1) // 2
  FROM w LEFT JOIN t ON t.k = w.k AND t.level = w.level AND t.pos = xor(w.pos, 1) WHERE w.n > 1
), x(k, own, level, pos, h, proof, n) AS (
  SELECT w.k, w.own, CAST(0 AS BIGINT), s.pos, w.h, w.proof, s.n FROM w JOIN s ON s.k = w.k WHERE w.n = 1
  UNION ALL
  SELECT x.k, x.own, x.level + 1, x.pos // 2,
         sha256(CASE WHEN x.pos % 2 = 1 THEN u.h || x.h ELSE x.h || coalesce(u.h, '') END), x.proof || coalesce(u.h, ''), (x.n + 1) // 2
  FROM x LEFT JOIN u ON u.level = x.level AND u.pos = xor(x.pos, 1) WHERE x.n > 1
)
SELECT d.doc_id, d.leaf, s.h AS subroot, r.h AS root, sha256(x.proof) AS proof_sha256, x.h AS folded_root, x.h = r.h AS verified, d.pos AS leaf_index
FROM d JOIN s ON s.k = d.k JOIN x ON x.k = d.k AND x.own = d.pos AND x.n = 1 CROSS JOIN (SELECT h FROM u WHERE n = 1) r
"""


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    return Manifest(table(spark, sf_dir, "documents"), tampered).proofs()
