"""Token counts as rollups that are kept up to date by signed deltas.

The state is a folder of committed batches. A batch of changes (insert, delete or revise a
document) is counted with every tokenizer version, compared with the ledger's last entry for each
document it names, and turned into signed differences per source, language and tokenizer version.
Its ledger entries and its differences are written under the batch's own name, and a commit record
last. Totals are the sum of the differences of the committed batches: counts are additive, so no
document is counted again. Compaction replaces the batches so far by one, in the same way.

A batch that has a commit record isn't applied again; one that failed halfway has none, is never
read, and is written anew under a new name. So applying a batch any number of times counts once.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import scratch_path, ship, table

KEYS = ("source", "lang", "tokenizer")
SUMS = ("documents", "tokens", "bytes")
COMMITS = "batch string, sequence long, path string, compacted boolean"


def pattern_tokens(pattern: str) -> Callable[[Column], Column]:
    """A tokenizer version whose tokens are the matches of a regular expression."""
    return lambda text: F.regexp_count(text, F.lit(pattern)).cast("long")


def piece_tokens(path: str) -> Callable[[Column], Column]:
    """A tokenizer version that counts the ids of a byte-pair vocabulary in tiktoken's format."""
    import public_tokenizers

    split = public_tokenizers.PATTERN

    @F.pandas_udf("long")
    def count(texts: pd.Series) -> pd.Series:
        import base64

        import tiktoken

        if path not in _encodings:
            with open(path, "rb") as file:
                ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
            _encodings[path] = tiktoken.Encoding("own", pat_str=split, mergeable_ranks=ranks, special_tokens={})
        encoding = _encodings[path]
        return texts.map(lambda t: None if t is None else len(encoding.encode_ordinary(t)))

    return lambda text: count(text)


_encodings: dict = {}

#: Versions by name: words as the other operators take them; runs of letters, of digits, and signs.
VERSIONS = {
    "words-1": pattern_tokens(r"[^\x20\x09-\x0D]+"),
    "marks-1": pattern_tokens(r"[A-Za-z\x{80}-\x{10FFFF}]+|[0-9]+|[^A-Za-z0-9\x20\x09-\x0D\x{80}-\x{10FFFF}]"),
}


class Rollup:
    """The rollup in one folder of shared storage; one writer at a time, any number of readers."""

    def __init__(self, spark: SparkSession, folder: str, versions: dict[str, Callable[[Column], Column]] | None = None):
        self.spark, self.folder = ship(spark), folder
        self.versions = VERSIONS if versions is None else versions

    def commits(self) -> list[tuple[str, int, str, bool]]:
        """(batch, sequence, path, compacted) of all commit records, in order."""
        jvm = self.spark._jvm
        where = jvm.org.apache.hadoop.fs.Path(f"{self.folder}/commits")
        files = where.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not files.exists(where):
            return []
        rows = self.spark.read.schema(COMMITS).parquet(f"{self.folder}/commits").collect()  # one row per batch
        return sorted(((r.batch, r.sequence, r.path, bool(r.compacted)) for r in rows), key=lambda c: c[1])

    def _live(self) -> list[str]:
        paths: list[str] = []
        for _, _, path, compacted in self.commits():
            paths = [path] if compacted else [*paths, path]
        return paths

    def _commit(self, batch: str, path: str, compacted: bool = False) -> None:
        last = max((c[1] for c in self.commits()), default=-1)
        self.spark.createDataFrame([(batch, last + 1, path, compacted)], COMMITS).coalesce(1).write.mode("append").parquet(f"{self.folder}/commits")

    def ledger(self) -> DataFrame:
        """The last committed entry of each document: id, source, lang, bytes, counts; deleted ones
        have null counts."""
        paths = self._live()
        kinds = "id long, source string, lang string, bytes long, counts map<string,long>, sequence long, batch string"
        if not paths:
            return self.spark.createDataFrame([], kinds)
        entries = self.spark.read.schema(kinds).parquet(*[f"{p}/ledger" for p in paths])
        value = F.struct("source", "lang", "bytes", "counts", "batch")
        last = entries.groupBy("id").agg(F.max_by(value, F.col("sequence")).alias("e"), F.max("sequence").alias("sequence"))
        return last.select("id", "e.source", "e.lang", "e.bytes", "e.counts", "sequence", "e.batch")

    def totals(self) -> DataFrame:
        """source, lang, tokenizer, documents, tokens, bytes; groups without documents are left out."""
        paths = self._live()
        kinds = "source string, lang string, tokenizer string, documents long, tokens long, bytes long"
        if not paths:
            return self.spark.createDataFrame([], kinds)
        deltas = self.spark.read.schema(kinds).parquet(*[f"{p}/deltas" for p in paths])
        return deltas.groupBy(*KEYS).agg(*[F.sum(c).alias(c) for c in SUMS]).where("documents <> 0")

    def apply(self, batch: str, changes: DataFrame) -> bool:
        """Commit ``changes`` (op, doc_id, source, lang, text); False if ``batch`` is committed.

        op is insert, revise (both put the document in this state) or delete; a delete of an unknown
        document changes nothing. Of several changes of one document in a batch, a delete counts
        before others and then the greatest by (source, lang, text), so the order of rows doesn't
        matter. Rows without doc_id or with another op are left out; a null text has no tokens and
        no bytes; null source and language are groups of their own. An empty batch is committed."""
        if any(c[0] == batch and not c[3] for c in self.commits()):
            return False
        known = changes.where(F.col("doc_id").isNotNull() & F.col("op").isin("insert", "revise", "delete"))
        text = F.coalesce(F.col("text"), F.lit(""))
        counts = F.create_map(*[x for name, count in self.versions.items() for x in (F.lit(name), count(text))])
        gone = F.col("op") == "delete"
        counted = known.select(
            F.col("doc_id").cast("long").alias("id"), gone.alias("gone"),
            F.when(~gone, F.col("source")).alias("source"), F.when(~gone, F.col("lang")).alias("lang"),
            F.when(~gone, F.octet_length(text).cast("long")).alias("bytes"), F.when(~gone, counts).alias("counts"),
            F.when(~gone, F.xxhash64("text")).alias("tie"),
        )
        pick = F.struct("gone", "source", "lang", "tie")
        new = counted.groupBy("id").agg(F.max_by(F.struct("source", "lang", "bytes", "counts"), pick).alias("new"))
        old = self.ledger().select("id", F.struct("source", "lang", "bytes", "counts").alias("old"))
        path = f"{self.folder}/batches/{uuid.uuid4().hex}"
        sequence = len(self.commits())
        new.select("id", "new.*", F.lit(sequence).cast("long").alias("sequence"), F.lit(batch).alias("batch")).write.parquet(f"{path}/ledger")
        # from the written ledger: what is summed is what later batches compare with
        written = self.spark.read.parquet(f"{path}/ledger").select("id", F.struct("source", "lang", "bytes", "counts").alias("new"))
        both = written.join(old, "id", "left")
        signed = F.explode(F.array(F.struct(F.lit(1).alias("sign"), F.col("new").alias("s")), F.struct(F.lit(-1).alias("sign"), F.col("old").alias("s"))))
        sides = both.select(signed.alias("x")).select("x.sign", "x.s.*").where("counts IS NOT NULL")
        each = sides.select("sign", "source", "lang", "bytes", F.explode("counts").alias("tokenizer", "tokens"))
        deltas = each.groupBy(*KEYS).agg(
            F.sum("sign").cast("long").alias("documents"), F.sum(F.col("sign") * F.col("tokens")).cast("long").alias("tokens"),
            F.sum(F.col("sign") * F.col("bytes")).cast("long").alias("bytes"),
        )
        deltas.where("documents <> 0 OR tokens <> 0 OR bytes <> 0").write.parquet(f"{path}/deltas")
        self._commit(batch, path)
        return True

    def compact(self) -> None:
        """Replace the committed batches by one with the same totals and ledger."""
        path = f"{self.folder}/batches/{uuid.uuid4().hex}"
        self.ledger().write.parquet(f"{path}/ledger")
        self.totals().write.parquet(f"{path}/deltas")
        self._commit("compacted", path, compacted=True)


NAME = "op1_token_counts"
SQL = r"""
WITH ranked AS (
  SELECT *, row_number() OVER (PARTITION BY text ORDER BY doc_id) AS copy FROM documents WHERE doc_id IS NOT NULL
), final AS (
  SELECT source, lang,
         CASE WHEN doc_id % 10 = 3 THEN regexp_replace(coalesce(text, ''), '[0-9]', '', 'g') ELSE coalesce(text, '') END AS text
  FROM ranked WHERE copy = 1
), counted AS (
  SELECT source, lang, 'words-1' AS tokenizer, len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS tokens, strlen(text) AS bytes FROM final
  UNION ALL
  SELECT source, lang, 'marks-1' AS tokenizer,
         len(regexp_extract_all(text, '[A-Za-z\x{80}-\x{10FFFF}]+|[0-9]+|[^A-Za-z0-9\x20\x09-\x0D\x{80}-\x{10FFFF}]')) AS tokens, strlen(text) AS bytes
  FROM final
)
SELECT source, lang, tokenizer, CAST(count(*) AS BIGINT) AS documents, CAST(sum(tokens) AS BIGINT) AS tokens, CAST(sum(bytes) AS BIGINT) AS bytes
FROM counted GROUP BY source, lang, tokenizer
"""


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents are inserted, copies of a text deleted, digits taken out of a tenth by
    revision; the first batch is sent twice."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "lang", "text")
    rollup = Rollup(spark, scratch_path(spark, "token_rollup"))
    inserts = docs.withColumn("op", F.lit("insert"))
    rollup.apply("load", inserts)
    rollup.apply("load", inserts)
    # a text's hash is enough to find its copies without shuffling texts
    hashed = docs.where("doc_id IS NOT NULL").select("doc_id", F.xxhash64("text").alias("a"), F.md5("text").alias("b"))
    first = hashed.groupBy("a", "b").agg(F.min("doc_id").alias("first"), F.count("*").alias("n")).where("n > 1")
    copies = hashed.join(first, (hashed.a == first.a) & hashed.b.eqNullSafe(first.b)).where("doc_id <> first").select("doc_id")
    none = F.lit(None).cast("string")
    rollup.apply("copies", copies.select("doc_id", none.alias("source"), none.alias("lang"), none.alias("text"), F.lit("delete").alias("op")))
    kept = docs.join(copies, "doc_id", "left_anti").where(F.col("doc_id") % 10 == 3)
    rollup.apply("no digits", kept.withColumn("text", F.regexp_replace("text", "[0-9]", "")).withColumn("op", F.lit("revise")))
    return rollup.totals()
