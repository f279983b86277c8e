"""Sharding by a consistent-hash ring with virtual nodes and bounded loads.

The ring is cut into ``CELLS`` cells. Every shard owns ``VIRTUAL`` virtual nodes, placed by a hash of
(shard, node); a cell belongs to the next node clockwise. A key's cell is a hash of its id, so shard
and key places don't depend on the other shards. Every shard has a capacity; keys that find their
shard full continue clockwise to the next shard with room. All keys are tried at their first shard
before any is tried at its second, and so on, in ring order.

Rows are only counted by cell. Which part of which cell goes to which shard follows from these
counts, of which there are at most ``CELLS`` and a half however many rows there are, so the walk
around the ring is a loop over a bounded table. Rows then need their number within their cell, a
window, and look up their shard and slot.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import cut, prepare

SHARDS = 24
VIRTUAL = 256
CELLS = 1 << 16
#: Cells with more rows than this, and than twice the mean, are numbered in several parts.
CELL_ROWS = 4096

PIECE = "cell int, part int, first long, end long, shard int, slot0 long"


def cell_of(*keys):
    """A column's place on the ring: 16 bits of the md5 of its text; null has a place of its own."""
    text = F.concat_ws(":", *[F.coalesce(F.col(k).cast("string") if isinstance(k, str) else k.cast("string"), F.lit("-")) for k in keys])
    return F.conv(F.substring(F.md5(text), 1, 4), 16, 10).cast("int")


def ring(spark: SparkSession, shards: int, virtual: int = VIRTUAL) -> list[tuple[int, int]]:
    """(cell, shard) of all virtual nodes in ring order; of two in one cell the lower shard stays, so
    that a shard more takes no cell's node away from others."""
    nodes = spark.range(shards * virtual).select(
        F.floor(F.col("id") / virtual).cast("int").alias("shard"), (F.col("id") % virtual).alias("node")
    )
    placed = nodes.groupBy(cell_of(F.lit("node"), "shard", "node").alias("cell")).agg(F.min("shard").alias("shard"))
    return sorted((r.cell, r.shard) for r in placed.collect())  # at most shards * virtual


def capacities(rows: int, shards: int, slack: float = 0.0) -> list[int]:
    """What each shard may hold. Without slack the capacities sum up to the rows and differ by one at
    most, so that all are filled; with it each is (1 + slack) times the mean, rounded up."""
    if slack:
        return [-int(-rows * (1 + slack) // shards)] * shards
    return [rows // shards + (s < rows % shards) for s in range(shards)]


def walk(counts: Iterable[tuple[int, int, int]], nodes: Sequence[tuple[int, int]], room: Sequence[int]) -> list[tuple]:
    """Deal cells, (cell, part, rows) each, out to the shards: (cell, part, first row, end, shard, slot
    of the first row). ``nodes`` is the ring, ``room`` the shards' capacities."""
    room, filled = list(room), [0] * len(room)
    owners = [s for _, s in nodes]
    at, waiting = 0, []
    for cell, part, rows in sorted(counts):
        while at < len(nodes) and nodes[at][0] < cell:
            at += 1
        waiting.append((cell, part, 0, rows, at % len(nodes)))
    preferences: dict[int, list[int]] = {}

    def choice(node: int, k: int) -> int:
        if node not in preferences:
            preferences[node] = list(dict.fromkeys(owners[node:] + owners[:node]))
        return preferences[node][k]

    pieces = []
    for k in range(len(set(owners))):
        left = []
        for cell, part, first, end, node in waiting:
            shard = owners[node] if k == 0 else choice(node, k)
            take = min(end - first, room[shard])
            if take:
                pieces.append((cell, part, first, first + take, shard, filled[shard]))
                filled[shard] += take
                room[shard] -= take
            if take < end - first:
                left.append((cell, part, first + take, end, node))
        waiting = left
    if waiting:
        raise ValueError("the shards' capacities are smaller than the rows")
    return pieces


def place(docs: DataFrame, shards: int = SHARDS, virtual: int = VIRTUAL, slack: float = 0.0) -> DataFrame:
    """doc_id, size, text_crc32, shard, slot of every row of ``docs``.

    size: UTF-8 bytes of the text plus 8, a null text has none; text_crc32 is null for it. slot
    counts each shard's rows from 0. Without ``slack`` the shards' rows differ by one at most; with
    it none holds more than (1 + slack) times the mean, and fewer rows move when shards or rows come
    and go. A null doc_id is a key like others; repeated rows are placed one by one, near each
    other on the ring; a key that holds many rows fills its shard and continues clockwise. Empty input
    gives no rows. Other columns are neither read nor returned.
    """
    spark = prepare(docs.sparkSession)
    keyed = cut(docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + 8).alias("size"),
        F.crc32(F.col("text").cast("binary")).alias("text_crc32"),
        cell_of("doc_id").alias("cell"),
        F.monotonically_increasing_id().alias("row"),
    ))
    counts = [(r.cell, r.n) for r in keyed.groupBy("cell").agg(F.count("*").alias("n")).collect()]  # at most CELLS
    total = sum(n for _, n in counts)
    most = max(CELL_ROWS, -(-2 * total // CELLS))
    # the rows of a hot key stand in one cell: at most CELLS / 2 cells are numbered in parts
    split = spark.createDataFrame([(c, -(-n // most)) for c, n in counts if n > most], "cell int, parts int")
    parted = keyed.join(F.broadcast(split), "cell", "left").withColumn(
        "part", F.coalesce(F.pmod(F.xxhash64("row"), F.col("parts")), F.lit(0)).cast("int")
    )
    hot = parted.where("parts IS NOT NULL").groupBy("cell", "part").agg(F.count("*").alias("n")).collect() if any(n > most for _, n in counts) else []
    sizes = [(c, 0, n) for c, n in counts if n <= most] + [(r.cell, r.part, r.n) for r in hot]
    pieces = walk(sizes, ring(spark, shards, virtual), capacities(total, shards, slack))
    order = Window.partitionBy("cell", "part").orderBy(F.md5(F.col("doc_id").cast("string")), "doc_id", "size", "text_crc32", "row")
    ranked = parted.withColumn("at", F.row_number().over(order) - 1)
    dealt = F.broadcast(spark.createDataFrame(pieces, PIECE))  # at most 1.5 * CELLS + shards rows
    return ranked.join(dealt, ["cell", "part"]).where("first <= at AND at < end").select(
        "doc_id", "size", "text_crc32", "shard", (F.col("slot0") + F.col("at") - F.col("first")).alias("slot")
    )


NAME = "op12_bounded_ring"


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = prepare(spark).read.parquet(f"{sf_dir}/documents.parquet")
    return place(docs).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


# The walk is a loop over counts; a test places keys one by one instead.
SQL = None
