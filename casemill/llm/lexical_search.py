"""Ranked lexical search: short lists term at a time, long lists document at a time.

The queries are a stated set of items, so only their terms are indexed. One pass over the documents
counts terms and writes segments: up to ``SEGMENT_DOCS`` documents with the postings of all items'
terms. Document frequencies are sums over the segments. A second pass answers all items in each
segment, and a window ranks the best of all tasks.

Within a segment and for one item, lists of at most 1 / ``SHORT`` of the documents are short. They are
materialised into accumulators, term at a time, and the accumulators are from then on one more
iterator with a bound of its own. Document at a time, it goes over the segment together with the long
lists: windows of ``WINDOW`` documents whose bound (the accumulators' maximum plus each long list's)
doesn't reach the k-th best score so far are skipped; in the others a document is dropped as soon
as its score so far and what the remaining lists can add don't reach it.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import cut
from .tables import ship, table

SEGMENT_DOCS = 8192
SEGMENT_POSTINGS = 1 << 20
SHORT = 32
WINDOW = 64
#: Windows that are looked at together before the threshold is raised.
STRIDE = 16
#: Items are taken in blocks of about so many terms; each block is one pass over the documents.
BLOCK_TERMS = 1 << 18
PIECE_BYTES = 1 << 20

#: ASCII signs to blanks, A-Z lowered, all else (0-9, a-z and whatever isn't ASCII) as it is.
_FOLD = bytes((b + 32 if 65 <= b <= 90 else b) if 48 <= b <= 57 or 65 <= b <= 90 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def terms_of(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a text, in pieces that end between terms."""
    folded, at = text.translate(_FOLD), 0
    while at < len(folded):
        end = len(folded) if at + PIECE_BYTES >= len(folded) else folded.find(b" ", at + PIECE_BYTES)
        end = len(folded) if end < 0 else end
        yield folded[at:end].split()
        at = end


def weight(docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * docs + 2) / (2 * df + 1)))


SEGMENT = "n_docs long, n_terms long, ids array<long>, lengths array<long>, terms array<int>, sizes array<int>, docs binary, tfs binary"


class _Segment:
    """Postings of documents gathered so far."""

    def __init__(self):
        self.n_docs = self.n_terms = 0
        self.ids, self.lengths, self.terms, self.docs, self.tfs = [], [], [], [], []

    def add(self, doc_id, counts: Counter, n: int, vocabulary: dict) -> None:
        if not n:
            return
        self.n_docs += 1
        self.n_terms += n
        found = [(vocabulary[t], k) for t, k in counts.items() if t in vocabulary]
        if found:
            doc = len(self.ids)
            self.ids.append(doc_id)
            self.lengths.append(n)
            self.terms.extend(t for t, _ in found)
            self.tfs.extend(k for _, k in found)
            self.docs.extend([doc] * len(found))

    def row(self) -> pa.RecordBatch:
        terms, docs = np.asarray(self.terms, np.int32), np.asarray(self.docs, np.int32)
        order = np.lexsort((docs, terms))
        distinct, sizes = np.unique(terms, return_counts=True)
        values = (
            pa.array([self.n_docs], pa.int64()), pa.array([self.n_terms], pa.int64()), pa.array([self.ids], pa.list_(pa.int64())),
            pa.array([self.lengths], pa.list_(pa.int64())), pa.array([distinct], pa.list_(pa.int32())),
            pa.array([sizes.astype(np.int32)], pa.list_(pa.int32())), pa.array([docs[order].tobytes()], pa.binary()),
            pa.array([np.asarray(self.tfs, np.int64)[order].tobytes()], pa.binary()),
        )
        return pa.RecordBatch.from_arrays(list(values), names=["n_docs", "n_terms", "ids", "lengths", "terms", "sizes", "docs", "tfs"])


def _index(vocabulary: dict):
    def run(batches):
        segment = _Segment()
        for b in batches:
            for doc_id, text in zip(b.column("doc_id"), b.column("text")):
                counts, n = Counter(), 0
                for piece in terms_of(text.as_py() or b""):
                    counts.update(piece)
                    n += len(piece)
                segment.add(doc_id.as_py(), counts, n, vocabulary)
                if segment.n_docs >= SEGMENT_DOCS or len(segment.terms) >= SEGMENT_POSTINGS:
                    yield segment.row()
                    segment = _Segment()
        if segment.n_docs:
            yield segment.row()

    return run


class Searcher:
    """Answers items in one segment after the other; keeps each item's k best so far."""

    def __init__(self, items: list[list[tuple[int, int]]], docs: int, terms: int, k: int):
        self.items, self.docs, self.terms, self.k = items, docs, terms, k
        self.best = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)) for _ in items]
        self.looked_at = 0  # documents in windows that were not skipped

    def _keep(self, i: int, scores, ids, missing) -> None:
        """Merge into the k best of item i: highest score, then smallest id, null last."""
        s, d, m = self.best[i]
        s, d, m = np.concatenate([s, scores]), np.concatenate([d, ids]), np.concatenate([m, missing])
        order = np.lexsort((d, m, -s))[: self.k]
        self.best[i] = s[order], d[order], m[order]

    def _floor(self, i: int) -> int:
        """What a document must score to come among the k best; an equal score may, by its id."""
        scores = self.best[i][0]
        return int(scores[-1]) if len(scores) == self.k else 1

    def _seeded(self, accumulated, rows, weights, dense) -> int:
        """The k-th score of the documents with the greatest accumulators: no less is needed."""
        if len(accumulated) < self.k or not accumulated.any():
            return 1
        seeds = np.argpartition(-accumulated, self.k - 1)[: self.k]
        return max(1, int((accumulated[seeds] + weights @ dense[np.ix_(rows, seeds)]).min()))

    def add(self, ids, missing, lengths, terms, sizes, docs, tfs) -> None:
        size = len(ids)
        if not size:
            return
        padded = -(-size // WINDOW) * WINDOW
        m = 10 + (90 * lengths * self.docs) // self.terms
        impact = (1_000_000_000 * tfs) // (1000 * tfs + 8 * m[docs])
        ends = np.cumsum(sizes)
        lists, rows = {}, []
        for t, end, n in zip(terms.tolist(), ends.tolist(), sizes.tolist()):
            part = slice(end - n, end)
            if n * SHORT <= size:
                lists[t] = docs[part], impact[part]
            else:
                lists[t] = len(rows)
                whole = np.zeros(padded, np.int64)
                whole[docs[part]] = impact[part]
                rows.append(whole)
        dense = np.stack(rows) if rows else np.zeros((0, padded), np.int64)
        most = dense.reshape(len(rows), -1, WINDOW).max(2) if rows else np.zeros((0, padded // WINDOW), np.int64)
        for i, item in enumerate(self.items):
            self._answer(i, [(lists[t], w) for t, w in item if w and t in lists], dense, most, ids, missing, padded)

    def _answer(self, i, parts, dense, most, ids, missing, padded) -> None:
        accumulated = np.zeros(padded, np.int64)
        long_rows, long_weights = [], []
        for found, w in parts:
            if isinstance(found, tuple):  # a short list: term at a time
                accumulated[found[0]] += w * found[1]
            else:
                long_rows.append(found)
                long_weights.append(w)
        weights = np.asarray(long_weights, np.int64)
        rows = np.asarray(long_rows, np.int64)
        add = weights[:, None] * most[rows] if len(rows) else np.zeros((0, padded // WINDOW), np.int64)
        order = np.argsort(-add.sum(1), kind="stable")  # the lists that can add most come first
        rows, weights, add = rows[order], weights[order], add[order]
        bound = accumulated.reshape(-1, WINDOW).max(1) + add.sum(0)
        at, seeded = 0, self._seeded(accumulated, rows, weights, dense)
        windows = np.flatnonzero(bound >= max(seeded, self._floor(i)))
        while at < len(windows):
            chunk = windows[at : at + STRIDE]
            at += STRIDE
            floor = max(seeded, self._floor(i))
            chunk = chunk[bound[chunk] >= floor]
            if not len(chunk):
                continue
            docs = (chunk[:, None] * WINDOW + np.arange(WINDOW)).ravel()
            self.looked_at += len(docs)
            docs = docs[docs < len(ids)]
            score = accumulated[docs]
            ahead = np.cumsum(add[::-1], 0)[::-1]  # what this list and those after it can add, by window
            for j in range(len(rows)):
                alive = score + ahead[j][docs // WINDOW] >= floor
                docs, score = docs[alive], score[alive]
                score = score + weights[j] * dense[rows[j]][docs]
            good = score >= floor
            if good.any():
                docs = docs[good]
                self._keep(i, score[good], ids[docs], missing[docs])

    def rows(self) -> pa.RecordBatch:
        item = np.repeat(np.arange(len(self.best), dtype=np.int32), [len(b[0]) for b in self.best])
        join = lambda k, kind: np.concatenate([b[k] for b in self.best]) if self.best else np.zeros(0, kind)
        return pa.RecordBatch.from_arrays(
            [pa.array(item), pa.array(join(1, np.int64), pa.int64(), mask=join(2, bool)), pa.array(join(0, np.int64))], names=["item", "doc_id", "score"]
        )


def _search(items: list[list[tuple[int, int]]], docs: int, terms: int, k: int):
    def run(batches):
        searcher = Searcher(items, docs, terms, k)
        for b in batches:
            for i in range(len(b)):
                values = {n: b.column(n)[i] for n in b.schema.names}
                ids = values["ids"].values
                searcher.add(
                    np.asarray(ids.fill_null(0)), np.asarray(ids.is_null()), np.asarray(values["lengths"].values), np.asarray(values["terms"].values),
                    np.asarray(values["sizes"].values).astype(np.int64), np.frombuffer(values["docs"].as_buffer(), np.int32), np.frombuffer(values["tfs"].as_buffer(), np.int64),
                )
        yield searcher.rows()

    return run


def _blocks(items: DataFrame) -> Iterator[list[tuple[object, list[bytes]]]]:
    """(item_id, its distinct terms) of all items, in blocks of a bounded number of terms."""
    block, size = [], 0
    for row in items.toLocalIterator():
        found = sorted({t for piece in terms_of(bytes(row.text or b"")) for t in piece})
        if block and size + len(found) > BLOCK_TERMS:
            yield block
            block, size = [], 0
        block.append((row.item_id, found))
        size += len(found)
    if block:
        yield block


def top_documents(docs: DataFrame, items: DataFrame, k: int = 10) -> DataFrame:
    """item_id, rank (from 1), doc_id, score: each item's k best documents with a score above 0.

    Every row of ``items`` (item_id, text) is answered by itself, also if an id or a text is repeated
    or the id is null; a null or termless text has no rows. Documents (doc_id, text) are ranked row by
    row, repeated ids and texts too; equal scores go by ascending doc_id, a null one last. Empty
    tables give no rows. Other columns are not read.
    """
    spark = ship(docs.sparkSession)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    kind = dict(items.dtypes)["item_id"]
    answers = []
    for block in _blocks(items.select("item_id", F.col("text").cast("binary").alias("text"))):
        vocabulary = {t: i for i, t in enumerate(sorted({t for _, found in block for t in found}))}
        segments = cut(texts.mapInArrow(_index(vocabulary), SEGMENT))
        total = segments.agg(F.sum("n_docs").alias("docs"), F.sum("n_terms").alias("terms")).first()
        if not total.docs:
            continue
        listed = segments.select(F.explode(F.arrays_zip("terms", "sizes")).alias("l"))
        df = {r.term: r.df for r in listed.groupBy(F.col("l.terms").alias("term")).agg(F.sum("l.sizes").alias("df")).collect()}  # the block's terms
        weighted = [[(vocabulary[t], weight(total.docs, df[vocabulary[t]])) for t in found if vocabulary[t] in df] for _, found in block]
        found = segments.mapInArrow(_search(weighted, total.docs, total.terms, k), "item int, doc_id long, score long")
        best = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
        ids = spark.createDataFrame([(i, item_id) for i, (item_id, _) in enumerate(block)], f"item int, item_id {kind}")
        ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
        answers.append(ranked.join(F.broadcast(ids), "item").select("item_id", "rank", "doc_id", "score"))  # one block's ids
    out = spark.createDataFrame([], f"item_id {kind}, rank int, doc_id long, score long")
    for a in answers:
        out = out.unionByName(a) if len(answers) > 1 else a
    return out


NAME = "op13_hybrid_search"
SQL = r"""
WITH d AS (
  SELECT doc_id, row_number() OVER () AS r,
         regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS t
  FROM documents WHERE text IS NOT NULL
), b AS (
  SELECT item_id, row_number() OVER () AS i,
         list_distinct(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t
  FROM benchmark WHERE text IS NOT NULL
), bt AS (SELECT item_id, i, unnest(t) AS term FROM b
), c AS (SELECT CAST(count(*) AS BIGINT) AS n, CAST(sum(len(t)) AS BIGINT) AS l FROM d WHERE len(t) > 0
), m AS (SELECT doc_id, r, 10 + (90 * len(t) * c.n) // c.l AS m, t FROM d, c WHERE len(t) > 0
), p AS (
  SELECT doc_id, r, m, term, CAST(count(*) AS BIGINT) AS tf FROM (SELECT doc_id, r, m, unnest(t) AS term FROM m)
  WHERE term IN (SELECT term FROM bt) GROUP BY ALL
), w AS (
  SELECT term, CAST(floor(1000 * ln(CAST(2 * c.n + 2 AS DOUBLE) / CAST(2 * df + 1 AS DOUBLE))) AS BIGINT) AS w
  FROM (SELECT term, count(*) AS df FROM p GROUP BY term), c
), s AS (
  SELECT bt.item_id, bt.i, p.doc_id, p.r, CAST(sum(w.w * ((1000000000 * p.tf) // (1000 * p.tf + 8 * p.m))) AS BIGINT) AS score
  FROM bt JOIN w ON w.term = bt.term JOIN p ON p.term = bt.term GROUP BY ALL
), k AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER) AS rank FROM s WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM k WHERE rank <= 10
"""


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
