"""Benchmark decontamination by pigeonhole edit matching.

A test item of m characters with an error budget of k edits is split into k + 1 pieces. Whatever
passage of a document is within k edits of the item holds at least one piece unchanged. All pieces
are looked for at once with an Aho-Corasick automaton; around each hit Myers' bit-parallel
algorithm computes the smallest edit distance between the item and any passage there.

Items and texts are compared in lower case with runs of white space as one space. Items come to the
tasks in blocks of at most ``BLOCK_CHARS`` characters; there are as many passes as blocks.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import kernel
from .tables import ship, table

RATE = 0.05
MIN_CHARS = 20
BLOCK_CHARS = 4 << 20

_automata: dict[str, ahocorasick.Automaton] = {}


def normal(text: str | None) -> str:
    return " ".join((text or "").lower().split())


def pieces(item: str, budget: int) -> list[tuple[int, str]]:
    """(offset, piece): budget + 1 pieces of nearly equal length that make up the item."""
    edges = [len(item) * i // (budget + 1) for i in range(budget + 2)]
    return [(a, item[a:b]) for a, b in zip(edges, edges[1:]) if b > a]


def best_end(pattern: str, text: str) -> tuple[int, int]:
    """(distance, end): the smallest edit distance between the pattern and any passage of the text,
    and where the first such passage ends (Myers' algorithm, one bit per pattern character)."""
    m = len(pattern)
    masks: dict[str, int] = {}
    for i, c in enumerate(pattern):
        masks[c] = masks.get(c, 0) | 1 << i
    full, top = (1 << m) - 1, 1 << (m - 1)
    pv, mv, distance = full, 0, m
    best, end = m, 0
    for j, c in enumerate(text):
        eq = masks.get(c, 0)
        xv = eq | mv
        xh = (((eq & pv) + pv) ^ pv) | eq
        ph = (mv | ~(xh | pv)) & full
        mh = pv & xh
        if ph & top:
            distance += 1
        elif mh & top:
            distance -= 1
        ph = ph << 1 & full
        mh = mh << 1 & full
        pv = (mh | ~(xv | ph)) & full
        mv = ph & xv
        if distance < best:
            best, end = distance, j + 1
    return best, end


def match(item: str, text: str) -> tuple[int, int, int]:
    """(distance, start, end) of the passage nearest to the item; the earliest end, then the
    shortest passage."""
    at = text.find(item)
    if at >= 0:
        return 0, at, at + len(item)
    distance, end = best_end(item, text)
    _, length = best_end(item[::-1], text[:end][::-1])
    return distance, end - length, end


def automaton(items: list[tuple[int, str, int]]):
    """Over all pieces of (item id, normal text, budget); a piece knows its items and offsets."""
    places: dict[str, list[tuple[int, int]]] = {}
    for i, (_, text, budget) in enumerate(items):
        for offset, piece in pieces(text, budget):
            places.setdefault(piece, []).append((i, offset))
    found = ahocorasick.Automaton()
    for piece, where in places.items():
        found.add_word(piece, (len(piece), where))
    found.make_automaton()
    return found


def matches(text: str, items, found) -> list[tuple[int, int, int, int]]:
    """(item number, distance, start, end) of the items within their budgets."""
    begins: dict[int, list[int]] = {}
    for end, (length, where) in found.iter(text):
        for i, offset in where:
            begins.setdefault(i, []).append(end + 1 - length - offset)
    out = []
    for i, starts in begins.items():
        _, item, budget = items[i]
        best = None
        lo = hi = None
        for start in [*sorted(set(starts)), None]:
            # windows that overlap are searched as one
            if lo is not None and (start is None or start - budget > hi):
                distance, a, b = match(item, text[lo:hi])
                if distance <= budget and (best is None or distance < best[0]):
                    best = distance, lo + a, lo + b
                lo = None
            if start is not None:
                if lo is None:
                    lo = max(0, start - budget)
                hi = start + len(item) + budget
        if best:
            out.append((i, *best))
    return sorted(out)


def blocks(benchmark: DataFrame, rate: float) -> Iterator[list[tuple[int, str, int]]]:
    """(item id, normal text, budget) in blocks of bounded size; items shorter than MIN_CHARS
    characters, null ones among them, are too short to tell and left out."""
    held, weight = [], 0
    for row in benchmark.select("item_id", "text").where("text IS NOT NULL").toLocalIterator():
        text = normal(row.text)
        if len(text) < MIN_CHARS:
            continue
        held.append((row.item_id, text, int(rate * len(text))))
        weight += len(text)
        if weight >= BLOCK_CHARS:
            yield held
            held, weight = [], 0
    if held:
        yield held


def _ready(shared):
    if shared.id not in _automata:
        _automata.clear()
        _automata[shared.id] = automaton(shared.value)
    return shared.value, _automata[shared.id]


class _Block:
    """A broadcast block with a name by which a worker knows its automaton. No other block ever
    has the name, as an address of the driver's memory might."""

    def __init__(self, broadcast):
        self.broadcast, self.id = broadcast, uuid.uuid4().hex

    @property
    def value(self):
        return self.broadcast.value


def _find(shared, names):
    def run(batches):
        items, found = _ready(shared)
        for batch in batches:
            texts = batch.column("_text").to_pylist()
            at, got = [], []
            for r, text in enumerate(texts):
                for hit in matches(normal(text), items, found) if text else ():
                    at.append(r)
                    got.append(hit)
            rows = pa.array(at, pa.int64())
            item = pa.array([items[i][0] for i, *_ in got], pa.int64())
            numbers = [pa.array([g[k] for g in got], pa.int32()) for k in (1, 2, 3)]
            yield pa.RecordBatch.from_arrays([batch.column(c).take(rows) for c in names] + [item, *numbers], names=[*names, "item_id", "distance", "start", "end"])

    return run


def find(docs: DataFrame, benchmark: DataFrame, keep: dict[str, Column], text: str = "text", rate: float = RATE) -> DataFrame:
    """A row per document and benchmark item that the document holds with at most
    floor(rate * length) edits: the columns of ``keep``, item_id, distance, start, end.

    start and end are places in the normalised text, those of the nearest passage. Null and empty
    texts hold nothing, and an empty benchmark gives no rows. Repeated documents or items are
    answered one by one. Texts are searched whole."""
    spark = ship(docs.sparkSession)
    names = [f"k{i}" for i in range(len(keep))]
    source = docs.select(*[c.alias(n) for n, c in zip(names, keep.values())], F.col(text).alias("_text"))
    kinds = ", ".join(f"{c} {source.schema[c].dataType.simpleString()}" for c in names)
    out = None
    for items in blocks(benchmark, rate):
        part = source.mapInArrow(_find(_Block(spark.sparkContext.broadcast(items)), names), f"{kinds}, item_id long, distance int, start int, end int")
        out = part if out is None else out.unionByName(part)
    if out is None:
        out = source.drop("_text").where("false").select("*", F.lit(0).cast("long").alias("item_id"), *[F.lit(0).alias(c) for c in ("distance", "start", "end")])
    return out.select(*[F.col(c).alias(n) for c, n in zip(names, keep)], "item_id", "distance", "start", "end")


def _clean(shared):
    def run(batches):
        items, found = _ready(shared)
        for batch in batches:
            clean = [not text or not matches(normal(text), items, found) for text in batch.column("_text").to_pylist()]
            names = [c for c in batch.schema.names if c != "_text"]
            yield batch.select(names).filter(pa.array(clean, pa.bool_()))

    return run


def without_leaks(docs: DataFrame, benchmark: DataFrame, text: str = "text", rate: float = RATE) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark item; all columns stay."""
    spark = ship(docs.sparkSession)
    names = docs.columns
    kept = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names)], F.col(text).alias("_text"))
    for items in blocks(benchmark, rate):
        shared = _Block(spark.sparkContext.broadcast(items))
        own = [c for c in kept.columns if c != "_text"]
        schema = ", ".join(f"{c} {kept.schema[c].dataType.simpleString()}" for c in own)
        kept = kept.mapInArrow(_clean(shared), schema).withColumn("_text", F.col(f"c{names.index(text)}"))
    return kept.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(names)])


NAME = "op7_pigeonhole_decontamination"
SQL = None


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), {"doc_id": F.col("doc_id")})


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that hold no benchmark item."""
    return without_leaks(docs, table(spark, sf_dir, "benchmark"))
