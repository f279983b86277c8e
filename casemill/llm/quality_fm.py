"""Quality classifier: a factorisation machine over hashed words, structure statistics and metadata.

A text becomes a sparse vector: hashed lower-case words with damped, normalised counts, structure
statistics cut into ranges (shares of upper case, digits, signs and marks, repeated words and lines,
word and line lengths), and the same for the metadata column n_chars. The score is

    sigmoid(bias + sum w_i x_i + 1/2 sum_f ((sum v_if x_i)^2 - sum (v_if x_i)^2)),

the sum-of-squares identity that makes all pairwise interactions cost as much as one pass over the
features. Training runs on features of at most ``SAMPLE`` labelled rows, chosen by a hash of
their id; the model has a fixed size and is broadcast; scoring runs over all rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import kernel
from .tables import fold, is_fold, ship, table

WORD_BITS = 16
RANGES = 16
STATISTICS = 14
SAMPLE = 6000
FACTORS = 8
THRESHOLD = 0.3
SIZE = (1 << WORD_BITS) + RANGES * STATISTICS
# byte classes: 0 other, 1 space, 2 lower, 3 upper, 4 digit, 5 sentence marks, 6 other signs, 7 high
_CLASS = np.zeros(256, np.uint8)
_CLASS[[9, 10, 11, 12, 13, 32]] = 1
_CLASS[97:123] = 2
_CLASS[65:91] = 3
_CLASS[48:58] = 4
_CLASS[[ord(c) for c in "#$%&*+/<=>@[\\]^_`{|}~"]] = 6
_CLASS[[ord(c) for c in ".,;:!?'\"()-"]] = 5
_CLASS[128:] = 7


def _per_row(mask: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    return np.diff(np.concatenate([[0], np.cumsum(mask)])[offsets])


def statistics(data, offsets, starts, ends, first, row, distinct_words, n_chars) -> np.ndarray:
    """[row, statistic] as range numbers 0..RANGES-1."""
    n = len(offsets) - 1
    size = np.diff(offsets)
    kind = _CLASS[data]
    words = np.diff(first)
    share = lambda k, of: _per_row(kind == k, offsets) / np.maximum(of, 1)
    dense = np.maximum(size - _per_row(kind == 1, offsets), 1)
    newline = data == 10
    lines = _per_row(newline, offsets) + (size > 0)
    word_bytes = np.bincount(row, ends - starts, n)
    same = np.zeros(len(data), bool)
    if len(data) > 1:
        same[1:] = data[1:] == data[:-1]
    # repeated neighbours among the words, and distinct lines
    prefix = kernel.rolling(data)
    line_starts = np.unique(np.concatenate([offsets[:-1][size > 0], np.flatnonzero(newline) + 1]))
    line_starts = line_starts[line_starts < len(data)]
    line_ends = np.append(line_starts[1:], len(data))
    line_row = np.searchsorted(offsets, line_starts, "right") - 1
    line_hash = kernel.span_hash(prefix, line_starts, line_ends)
    order = np.lexsort((line_hash, line_row))
    fresh = np.ones(len(order), bool)
    fresh[1:] = (line_hash[order][1:] != line_hash[order][:-1]) | (line_row[order][1:] != line_row[order][:-1])
    distinct_lines = np.bincount(line_row[order][fresh], minlength=n)
    all_lines = np.bincount(line_row, minlength=n)
    scaled = lambda x, top: np.sqrt(np.clip(x / top, 0, 1))  # noqa: E731  finer near zero
    logs = lambda x, top: np.log1p(x) / np.log1p(top)
    known = np.asarray([x is not None for x in n_chars])
    chars = np.asarray([x or 0 for x in n_chars], float)
    columns = [
        scaled(share(3, dense), 1), scaled(share(4, dense), 0.5), scaled(share(5, dense), 0.5), scaled(share(6, dense), 0.5),
        share(7, dense), distinct_words / np.maximum(words, 1), distinct_lines / np.maximum(all_lines, 1),
        word_bytes / np.maximum(words, 1) / 24, logs(words, 3e4), logs(size / np.maximum(lines, 1), 3e4),
        logs(lines, 3e3), scaled(_per_row(same, offsets) / np.maximum(size, 1), 0.5), scaled(share(1, np.maximum(size, 1)), 1),
        np.where(known, logs(np.maximum(chars, 0), 2e5), 1),
    ]
    return np.clip((np.stack(columns, 1) * RANGES).astype(int), 0, RANGES - 1)


def features(data, offsets, n_chars):
    """(row, feature, value) sorted by row; every row has its statistics, an empty text too."""
    n = len(offsets) - 1
    data = kernel.lower(data), data
    starts, ends, first = kernel.word_spans(data[0], offsets)
    hashes = kernel.span_hash(kernel.rolling(data[0]), starts, ends)
    row = np.repeat(np.arange(n), np.diff(first))
    bucket = hashes >> np.uint64(64 - WORD_BITS)
    key, count = np.unique(row.astype(np.uint64) << np.uint64(WORD_BITS) | bucket, return_counts=True)
    word_row = (key >> np.uint64(WORD_BITS)).astype(np.int64)
    value = np.log1p(count)
    norm = np.sqrt(np.bincount(word_row, value**2, n))
    value = value / np.maximum(norm, 1e-12)[word_row]
    ranges = statistics(data[1], offsets, starts, ends, first, row, np.bincount(word_row, minlength=n), n_chars)
    stat_row = np.repeat(np.arange(n), STATISTICS)
    stat = ((1 << WORD_BITS) + np.arange(STATISTICS) * RANGES + ranges).ravel()
    rows_ = np.concatenate([word_row, stat_row])
    order = np.argsort(rows_, kind="stable")
    return (
        rows_[order],
        np.concatenate([(key & np.uint64((1 << WORD_BITS) - 1)).astype(np.int64), stat])[order],
        np.concatenate([value, np.full(len(stat), 0.5)])[order],
    )


def margins(row, feature, value, n, bias, linear, factors):
    """The machine's raw output per row, pairwise terms by the sum-of-squares identity."""
    begin = np.searchsorted(row, np.arange(n))
    vx = factors[feature] * value[:, None]
    sums = np.add.reduceat(vx, begin, 0)
    squares = np.add.reduceat((vx**2).sum(1), begin)
    return bias + np.add.reduceat(linear[feature] * value, begin) + 0.5 * ((sums**2).sum(1) - squares), sums


def fit(row, feature, value, label, epochs=12, batch=64, rate=0.02, decay=1e-5, seed=7):
    """Adam on the logistic loss; both classes have the same total weight."""
    n, rng = len(label), np.random.default_rng(seed)
    linear, factors = np.zeros(SIZE), rng.normal(0, 0.01, (SIZE, FACTORS))
    m = [np.zeros_like(linear), np.zeros_like(factors)]
    s = [np.zeros_like(linear), np.zeros_like(factors)]
    begin = np.searchsorted(row, np.arange(n + 1))
    bias = 0.0 if 0 < label.sum() < n else float(np.log((label.sum() + 1) / (n - label.sum() + 1)))
    weight = np.where(label > 0, n / (2 * max(label.sum(), 1)), n / (2 * max(n - label.sum(), 1)))
    for epoch in range(epochs):
        step = rate / (1 + epoch / 3)
        order = rng.permutation(n)
        for lo in range(0, n, batch):
            picked = order[lo : lo + batch]
            at = np.concatenate([np.arange(begin[i], begin[i + 1]) for i in picked])
            r = np.repeat(np.arange(len(picked)), begin[picked + 1] - begin[picked])
            f, x = feature[at], value[at]
            out, sums = margins(r, f, x, len(picked), bias, linear, factors)
            error = (1 / (1 + np.exp(-np.clip(out, -30, 30))) - label[picked]) * weight[picked] / len(picked)
            used, where = np.unique(f, return_inverse=True)
            e = error[r] * x
            gl = np.bincount(where, e, len(used)) + decay * linear[used]
            pair = e[:, None] * (sums[r] - factors[f] * x[:, None])
            gf = np.stack([np.bincount(where, pair[:, k], len(used)) for k in range(FACTORS)], 1) + decay * factors[used]
            for k, (w, g) in enumerate(((linear, gl), (factors, gf))):
                m[k][used] = 0.9 * m[k][used] + 0.1 * g
                s[k][used] = 0.99 * s[k][used] + 0.01 * g * g
                w[used] -= step * m[k][used] / (np.sqrt(s[k][used]) + 1e-8)
            bias -= step * error.sum()
    return bias, linear.astype(np.float32), factors.astype(np.float32)


def _features(batches):
    for batch in batches:
        n_chars = batch.column("n_chars").to_pylist()
        for lo, hi, data, offsets in kernel.chunks(batch.column("text")):
            row, feature, value = features(data, offsets, n_chars[lo:hi])
            begin = np.searchsorted(row, np.arange(hi - lo + 1))
            yield kernel.rows(
                key=batch.column("key").slice(lo, hi - lo), label=batch.column("label").slice(lo, hi - lo),
                feature=kernel.lists(feature, begin, pa.int32()), value=kernel.lists(value, begin, pa.float32()),
            )


def learn(docs: DataFrame, labels: DataFrame, label: str = "quality", sample: int = SAMPLE):
    """A model from at most ``sample`` labelled rows, taken in the order of a hash of their id.

    Rows of ``labels`` without id or label are not used. Without any usable row, or with one class
    only, the model answers with that class's smoothed share. The same rows give the same model."""
    ship(docs.sparkSession)
    chosen = (
        labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull())
        .select("doc_id", (F.col(label) > 0).cast("int").alias("label"), F.xxhash64("doc_id").alias("key"))
        .orderBy("key", "doc_id", "label").limit(sample)
    )
    texts = docs.select("doc_id", "text", _n_chars(docs))
    found = (
        texts.join(F.broadcast(chosen), "doc_id").select("key", "label", "text", "n_chars")
        .mapInArrow(_features, "key long, label int, feature array<int>, value array<float>")
        .orderBy("key", "label").limit(sample).toArrow()
    )
    if not len(found):
        return 0.0, np.zeros(SIZE, np.float32), np.zeros((SIZE, FACTORS), np.float32)
    found = found.combine_chunks().sort_by([("key", "ascending"), ("label", "ascending")])
    lengths = found["feature"].combine_chunks().value_lengths().to_numpy()
    return fit(
        np.repeat(np.arange(len(found)), lengths), found["feature"].combine_chunks().flatten().to_numpy().astype(np.int64),
        found["value"].combine_chunks().flatten().to_numpy().astype(np.float64), found["label"].to_numpy().astype(float),
    )


def _n_chars(docs: DataFrame) -> Column:
    return (F.col("n_chars") if "n_chars" in docs.columns else F.lit(None)).cast("long").alias("n_chars")


def _score(model):
    def run(batches):
        bias, linear, factors = model.value
        for batch in batches:
            n_chars = batch.column("_n_chars").to_pylist()
            scores = []
            for lo, hi, data, offsets in kernel.chunks(batch.column("_text")):
                out, _ = margins(*features(data, offsets, n_chars[lo:hi]), hi - lo, bias, linear, factors)
                scores.append(1 / (1 + np.exp(-np.clip(out, -30, 30))))
            names = [c for c in batch.schema.names if c not in ("_text", "_n_chars")]
            scores = np.concatenate(scores) if scores else np.zeros(0)
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in names] + [pa.array(scores, pa.float64())], names=[*names, "_score"])

    return run


def score(docs: DataFrame, model, text: str = "text", as_column: str = "score") -> DataFrame:
    """``docs`` with a score from 0 to 1, higher for better texts; every column is kept.

    A null text counts as empty, and an empty text has a score of its own statistics. Texts are
    used whole, repeated rows scored one by one, an empty table stays empty. A column of the name
    ``as_column`` is replaced; language, source and ids are never looked at."""
    names = [c for c in docs.columns if c != as_column]
    renamed = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names)], F.col(text).alias("_text"), _n_chars(docs).alias("_n_chars"))
    kept = ", ".join(f"c{i} {renamed.schema[f'c{i}'].dataType.simpleString()}" for i in range(len(names)))
    shared = ship(docs.sparkSession).sparkContext.broadcast(model)
    out = renamed.mapInArrow(_score(shared), f"{kept}, _score double")
    return out.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(names)], F.col("_score").alias(as_column))


def training_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "labels").where(fold("doc_id", 5) != 0)


NAME = "op5_quality_factorisation_machine"
SQL = None


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = learn(docs, training_rows(spark, sf_dir))
    scored = score(docs.select("doc_id", "text", "n_chars"), model)
    return scored.select(
        "doc_id", is_fold("doc_id", 5, 0).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    )


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the classifier doesn't reject."""
    model = learn(docs, training_rows(spark, sf_dir))
    return score(docs, model, as_column="_quality").where(F.col("_quality") >= THRESHOLD).drop("_quality")
