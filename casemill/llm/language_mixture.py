"""Language identification by multilingual mixture inference.

Each language is a distribution over hashed byte trigrams, counted over the labelled training
documents by a Spark aggregation. A document is a mixture of languages: expectation-maximisation
estimates the proportions that make its trigrams likeliest. Which languages belong to the mixture
is decided by penalised likelihood: starting from all of them, the least one is taken away again
and again, and the set with the best likelihood minus a price per language is kept.

The likelihood table has ``BUCKETS`` rows per language and is all that is broadcast; the number of
languages is checked.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import kernel
from .tables import fold, is_fold, ship, table

BUCKETS = 1 << 15
#: Bytes of text whose mixtures are estimated at once.
CHUNK = 1 << 18
MAX_LANGUAGES = 256
UNDETERMINED = "und"
# ASCII letters in lower case, other bytes of UTF-8 as they are, all else a space
_LETTERS = np.full(256, 32, np.uint8)
_LETTERS[128:] = np.arange(128, 256)
_LETTERS[97:123] = np.arange(97, 123)
_LETTERS[65:91] = np.arange(97, 123)


def trigrams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, bucket, count) of the trigrams that hold a letter, sorted by row and bucket.

    A text begins and ends with an implied space, so every text with a letter has a trigram."""
    n = len(offsets) - 1
    padded = np.full(len(data) + 2 * n, 32, np.uint8)
    row = np.repeat(np.arange(n), np.diff(offsets))
    padded[np.arange(len(data)) + 2 * row + 1] = _LETTERS[data]
    at = np.repeat(np.arange(n), np.diff(offsets) + 2)
    a, b, c = (padded[k : len(padded) - 2 + k].astype(np.uint64) for k in range(3))
    code = (a << np.uint64(16)) | (b << np.uint64(8)) | c
    # no run of two spaces first, none across two texts, not only spaces
    good = (at[:-2] == at[2:]) & ~((a == 32) & (b == 32)) & ~((b == 32) & (c == 32))
    bucket = kernel.mix(code[good]) >> np.uint64(64 - 15)
    key, count = np.unique(at[:-2][good].astype(np.uint64) * np.uint64(BUCKETS) + bucket, return_counts=True)
    return (key // np.uint64(BUCKETS)).astype(np.int64), (key % np.uint64(BUCKETS)).astype(np.int64), count


def _count(batches):
    totals: dict[str, np.ndarray] = {}
    for batch in batches:
        langs = np.asarray(batch.column("lang").to_pylist(), dtype=object)
        for lo, hi, data, offsets in kernel.chunks(batch.column("text")):
            row, bucket, count = trigrams(data, offsets)
            names = langs[lo:hi][row]
            for name in set(langs[lo:hi]):
                mine = names == name
                sums = totals.setdefault(name, np.zeros(BUCKETS, np.int64))
                sums += np.bincount(bucket[mine], count[mine], BUCKETS).astype(np.int64)
    for name, sums in totals.items():
        used = np.flatnonzero(sums)
        yield kernel.rows(
            lang=pa.array([name] * len(used), pa.string()), bucket=pa.array(used.astype(np.int32)), n=pa.array(sums[used])
        )


def learn(docs: DataFrame, text: str = "text", lang: str = "lang") -> tuple[list[str], np.ndarray]:
    """The languages in order and log-likelihoods [language, bucket], from all rows of ``docs``
    with a language; counts are smoothed by adding a half."""
    ship(docs.sparkSession)
    counted = (
        docs.where(F.col(lang).isNotNull()).select(F.col(lang).alias("lang"), F.col(text).alias("text"))
        .mapInArrow(_count, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    )
    languages = [r.lang for r in docs.where(F.col(lang).isNotNull()).select(F.col(lang).alias("lang")).distinct().limit(MAX_LANGUAGES + 1).collect()]
    if len(languages) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    languages.sort()
    sums = np.full((len(languages), BUCKETS), 0.5)
    if languages:
        got = counted.toPandas()  # at most languages * BUCKETS rows
        np.add.at(sums, (np.searchsorted(languages, got["lang"].to_numpy(str)), got["bucket"].to_numpy()), got["n"].to_numpy())
        sums /= sums.sum(1, keepdims=True)
    return languages, np.log(sums)


def mixtures(row, count, logp, n_rows, rounds, price):
    """Proportions [row, language] of each text's best language set.

    ``logp`` [language, entry] holds each entry's log-likelihood."""
    n_lang = len(logp)
    peak = logp.max(0) if n_lang else np.zeros(len(row))
    p = np.exp(logp - peak)
    total = np.bincount(row, count, n_rows)
    active = np.ones((n_rows, n_lang), bool)
    best, best_value = np.zeros((n_rows, n_lang)), np.full(n_rows, -np.inf)
    for size in range(n_lang, 0, -1):
        share = active / size
        for _ in range(rounds if size > 1 else 1):
            joint = share[row].T * p
            weight = count / joint.sum(0)
            grown = np.stack([np.bincount(row, j * weight, n_rows) for j in joint], 1)
            share = grown / np.maximum(total, 1)[:, None]
        likelihood = np.bincount(row, count * (np.log(np.maximum((share[row].T * p).sum(0), 1e-300)) + peak), n_rows)
        value = likelihood - price * (size - 1) * np.log(np.maximum(total, 2))
        better = value > best_value
        best[better], best_value[better] = share[better], value[better]
        least = np.where(active, share, np.inf).argmin(1)
        active[np.arange(n_rows), least] = False
    return best


def _predict(model, rounds, price, extra):
    def run(batches):
        languages, table_ = model.value
        for batch in batches:
            text = kernel.as_text(batch.column("text"))
            letters = np.asarray(pc.match_substring_regex(text, r"\p{L}"))
            names, scores, shares = [], [], []
            for lo, hi, data, offsets in kernel.chunks(text, CHUNK):
                row, bucket, count = trigrams(data, offsets)
                share = mixtures(row, count.astype(float), table_[:, bucket], hi - lo, rounds, price)
                top = share.argmax(1) if len(languages) else np.zeros(hi - lo, int)
                known = letters[lo:hi] & bool(len(languages))
                names += [languages[t] if k else UNDETERMINED for t, k in zip(top, known)]
                scores += [float(min(1.0, share[i, t])) if k else 0.0 for i, (t, k) in enumerate(zip(top, known))]
                shares += [[(languages[j], float(s[j])) for j in np.flatnonzero(s > 0)] if k else [] for s, k in zip(share, known)]
            mixed = pa.array(shares, pa.list_(pa.struct([("lang", pa.string()), ("share", pa.float64())])))
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in extra] + [pa.array(names, pa.string()), pa.array(scores, pa.float64()), mixed],
                names=[*extra, "lang_pred", "score", "mixture"],
            )

    return run


def identify(docs: DataFrame, model: tuple[list[str], np.ndarray], keep: dict[str, Column], text: str = "text", rounds: int = 12, price: float = 2.0) -> DataFrame:
    """One row per document: the columns of ``keep`` and then lang_pred, score, mixture.

    ``mixture`` lists the selected languages with their proportions; lang_pred is the largest (the
    first in alphabetical order when equal) and score its proportion. A text that is null, empty or
    without a letter gives ``und`` with score 0 and no mixture, and so does a model without
    languages. Texts of any length are used whole. Repeated rows are answered one by one."""
    source = docs.select(*[c.alias(f"_{n}") for n, c in keep.items()], F.col(text).alias("text"))
    extra = [f"_{n}" for n in keep]
    shared = ship(docs.sparkSession).sparkContext.broadcast(model)
    kept = ", ".join(f"`{c}` {source.schema[c].dataType.simpleString()}" for c in extra)
    out = source.mapInArrow(_predict(shared, rounds, price, extra), f"{kept}, lang_pred string, score double, mixture array<struct<lang:string,share:double>>")
    return out.select(*[F.col(f"_{n}").alias(n) for n in keep], "lang_pred", "score", "mixture")


NAME = "op8_language_mixture"
SQL = None


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = learn(docs.where(fold("doc_id", 4) != 2))
    return identify(docs, model, {"doc_id": F.col("doc_id"), "held_out": is_fold("doc_id", 4, 2)})
