"""Language-model scoring from a log-frequency Bloom filter.

The training documents' words and word pairs are counted exactly by Spark. Counts are quantised to
powers of two; an n-gram of level q is added to a Bloom filter once with each level from its
order's lowest up to q. The filter has a fixed number of bits and is broadcast. A count is read
back by probing levels upwards until one is missing; its level stands for the mean count of that
level, so no mass is lost to quantisation. Pair counts are interpolated with word counts; the
weights, one per level of the context, are fitted by expectation-maximisation over all training
tokens with one occurrence left out.

So that the filter's bits suffice for every corpus, the lowest stored level of the pairs, and then
of the words, rises with the histogram of all counts; pairs seen once are never stored there. N-grams
that a task doesn't find in the filter are asked for: its keys go to the blocks that were counted, each
block answers with the exact levels, and the answers go back to the texts they came from. So every
n-gram counts, whatever the filter has room for. A text is summed up by how often each triple of levels
(context, pair, word) occurs in it, which gives both the weights and the scores.

The base score needs every word's exact count. The most frequent words, a bounded number, are
looked up in a broadcast table; all others are joined with the word counts.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bitfilter, counting, kernel
from .tables import cut, is_fold, ship, table

FILTER_BITS, PROBES = 28, 4
#: Levels that may be added to the filter, from its bits: ten bits for each.
CAPACITY = (1 << FILTER_BITS) // 10
FREQUENT = 1 << 19
SMOOTHING = 0.1
LEVELS = counting.LEVELS
FLUSH_WORDS, MEASURED_WORDS = 1 << 20, 3 << 16
#: Triples of levels; a number from LEVELS up in place of a level is one that isn't known yet.
CODES = LEVELS**3
U64 = np.uint64
BEGIN, END = kernel.mix(np.array([11, 12], U64))


def tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the lower-cased words, each text closed by END, and the texts' offsets."""
    words, first = kernel.word_hashes(kernel.lower(data), offsets)
    return np.insert(words, first[1:], END), first + np.arange(len(first))


def pairs(token: np.ndarray, first: np.ndarray) -> np.ndarray:
    """A key for each token and the one before it (BEGIN before the first)."""
    before = np.empty_like(token)
    before[1:] = token[:-1]
    before[first[:-1]] = BEGIN
    return kernel.mix(before * U64(0x9E3779B97F4A7C15) + token)


def _gathered(batches, words=FLUSH_WORDS, text="text"):
    """(rows, token arrays) of a bounded size over the rows of a task."""
    held, size = [], 0
    for batch in batches:
        for lo, hi, data, offsets in kernel.chunks(batch.column(text)):
            token, first = tokens(data, offsets)
            held.append((batch.slice(lo, hi - lo), token, first))
            size += len(token)
            if size >= words:
                yield held
                held, size = [], 0
    if held:
        yield held


def _count_words(batches):
    for held in _gathered(batches):
        word, n = np.unique(np.concatenate([t for _, t, _ in held]), return_counts=True)
        yield kernel.rows(word=kernel.signed(word), n=n)


def _count_pairs(batches):
    yield from counting.packed(np.concatenate([pairs(t, f) for _, t, f in held]) for held in _gathered(batches))


class Model:
    """What is broadcast: the filter, mean counts per order and level, and the weights. ``rest`` isn't:
    the levels of all n-grams the filter doesn't store, by order and block."""

    def __init__(self, total, distinct, bits, lowest, means, weights, rest):
        self.total, self.distinct, self.bits, self.lowest, self.means, self.weights = total, distinct, bits, lowest, means, weights
        self.rest = rest

    def __getstate__(self):
        return self.__dict__ | {"rest": None}

    def levels(self, keys: np.ndarray, order: int) -> np.ndarray:
        """The stored level of each key, 0 for one that isn't found: probes go up until a level is missing."""
        salted = kernel.mix(keys + U64(order))
        return counting.levels(np.frombuffer(self.bits, np.uint8), FILTER_BITS, PROBES, salted, self.lowest[order - 1])

    def parts(self, code: np.ndarray):
        """For triples of levels: the context's level, the pair's and context's mean counts, P(word)."""
        context, pair, word = code // LEVELS**2, code // LEVELS % LEVELS, code % LEVELS
        p_word = (self.means[0][word] + SMOOTHING) / (self.total + SMOOTHING * (self.distinct + 1))
        return context, self.means[1][pair], self.means[0][context], p_word

    def log10(self, code: np.ndarray) -> np.ndarray:
        context, pair, whole, p_word = self.parts(code)
        w = self.weights[context]
        share = np.minimum(1, pair / np.maximum(whole, 1))
        return np.log10(w * share + (1 - w) * p_word)

    def fit(self, code: np.ndarray, n: np.ndarray) -> None:
        """The weights, from how often each triple of levels occurs in the training texts."""
        self.weights = np.zeros(LEVELS)
        context, pair, whole, word = self.parts(code)
        known = (context > 0) & (whole > 1)
        context, word, n = context[known], word[known], n[known].astype(float)
        share = np.clip((pair[known] - 1) / (whole[known] - 1), 0, 1)  # one left out
        for c in np.unique(context):
            mine, w = context == c, 0.3
            for _ in range(30):
                a = w * share[mine]
                w = float((n[mine] * a / (a + (1 - w) * word[mine])).sum() / n[mine].sum())
            self.weights[c] = min(w, 0.95)


def _stored(lowest: int):
    """The pairs of a level from ``lowest`` up."""

    def run(batches):
        for batch in batches:
            for block, keys, levels in zip(*(batch.column(c).to_pylist() for c in ("block", "keys", "levels"))):
                q = np.frombuffer(levels, np.uint8)
                key = (counting.unpacked(keys) | U64(block << 38))[q >= lowest]
                q = q[q >= lowest].astype(np.int32)
                yield kernel.rows(gram=np.full(len(key), 2, np.int32), key=kernel.signed(key), low=np.full(len(key), lowest, np.int32), high=q)

    return run


def _rest_pairs(lowest: int):
    """The pairs of a level below ``lowest``."""

    def run(batches):
        for batch in batches:
            for block, keys, levels in zip(*(batch.column(c).to_pylist() for c in ("block", "keys", "levels"))):
                q = np.frombuffer(levels, np.uint8)
                low = np.frombuffer(keys, np.uint8).reshape(-1, 5)[q < lowest]
                yield kernel.rows(gram=pa.array([2], pa.int32()), block=pa.array([block], pa.int32()), keys=kernel.binaries([low.tobytes()]), levels=kernel.binaries([q[q < lowest].tobytes()]))

    return run


def _rest_words(batches):
    """Words (key, q) by blocks of 48-bit keys, about a million at a time."""

    def packed(held):
        key, q = (np.concatenate(x) for x in zip(*held))
        order = np.argsort(key)
        used, keys, bounds = counting.split(key[order])
        q = q[order].astype(np.uint8)
        return kernel.rows(gram=np.full(len(used), 1, np.int32), block=used, keys=kernel.binaries(keys), levels=kernel.binaries([q[a:b].tobytes() for a, b in zip(bounds, bounds[1:])]))

    held, size = [], 0
    for batch in batches:
        held.append((np.asarray(batch.column("key")).view(U64) >> U64(16), np.asarray(batch.column("q"))))
        size += len(batch)
        if size >= FLUSH_WORDS:
            yield packed(held)
            held, size = [], 0
    if held:
        yield packed(held)


def _count(train: DataFrame, text: str) -> tuple[Model, DataFrame]:
    """The model without its weights, and the exact counts (word, n) of the training tokens."""
    spark = ship(train.sparkSession)
    docs = train.select(F.col(text).alias("text"))
    words = cut(docs.mapInArrow(_count_words, "word long, n long").groupBy("word").agg(F.sum("n").alias("n")))
    counted = cut(counting.levelled(docs, _count_pairs))
    size = words.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("total"), F.count("*").alias("distinct")).first()
    ends = words.where(F.col("word") == int(END.view(np.int64))).select(F.lit(int(BEGIN.view(np.int64))).alias("word"), "n")
    keyed = words.unionByName(ends).select(F.col("word").alias("key"), "n", counting.level("n").alias("q"))
    sums = np.zeros((2, LEVELS)), np.zeros((2, LEVELS))
    for r in keyed.groupBy("q").agg(F.count("*").alias("k"), F.sum("n").alias("n")).collect():
        sums[0][0, r.q], sums[1][0, r.q] = r.k, r.n
    each = counted.select(F.posexplode(F.arrays_zip("kinds", "total")).alias("q", "of")).groupBy("q")
    for r in each.agg(F.sum("of.kinds").alias("k"), F.sum("of.total").alias("n")).collect():
        sums[0][1, r.q], sums[1][1, r.q] = r.k, r.n
    lowest = lowest_levels(sums[0])
    means = np.divide(sums[1], sums[0], out=np.zeros_like(sums[1]), where=sums[0] > 0)
    kept = "gram int, key long, low int, high int"
    stored = keyed.where(F.col("q") >= lowest[0]).select(F.lit(1).alias("gram"), "key", F.lit(lowest[0]).alias("low"), F.col("q").alias("high"))
    stored = stored.unionByName(counted.mapInArrow(_stored(lowest[1]), kept)).mapInArrow(_salted, "key long, low int, high int")
    bits = bitfilter.build(stored, FILTER_BITS, PROBES).tobytes()
    rest = counted.select("block", "keys", "levels").mapInArrow(_rest_pairs(lowest[1]), REST)
    if lowest[0] > 1:
        rest = rest.unionByName(keyed.where(F.col("q") < lowest[0]).select("key", "q").mapInArrow(_rest_words, REST))
    return Model(size.total, size.distinct, bits, lowest, means, np.zeros(LEVELS), rest), words


REST = "gram int, block int, keys binary, levels binary"
#: What is known of a text and what is asked for, and the keys that a task asks for; a row has one or the other.
ASKING = {
    "_row": "long", "_chunk": "long", "n_tokens": "long", "_known": "long", "_base": "double", "_words": "array<long>", "_codes": "array<int>",
    "_times": "array<int>", "_context": "binary", "_pair": "binary", "_word": "binary", "_gram": "int", "_block": "int", "_keys": "binary",
}
TYPES = {"long": pa.int64(), "double": pa.float64(), "int": pa.int32(), "binary": pa.binary(), "array<long>": pa.list_(pa.int64()), "array<int>": pa.list_(pa.int32())}


def _narrow(x: np.ndarray) -> np.ndarray:
    return x.astype(np.uint8 if not len(x) or x.max() < 256 else np.int32)


def _cut_up(x: np.ndarray, begin: np.ndarray) -> pa.Array:
    return kernel.binaries([x[a:b].tobytes() for a, b in zip(begin, begin[1:])])


def _counted_codes(row: np.ndarray, code: np.ndarray, n: int) -> tuple[pa.Array, pa.Array]:
    """Per row its distinct codes and how often each occurs."""
    found, times = np.unique(row * CODES + code, return_counts=True)
    begin = np.searchsorted(found, np.arange(n + 1) * CODES)
    return kernel.lists((found % CODES).astype(np.int32), begin, pa.int32()), kernel.lists(times.astype(np.int32), begin, pa.int32())


def _measure(shared, names):
    def run(batches):
        model, frequent, counts = shared.value
        floor = model.total + SMOOTHING * (model.distinct + 1)
        chunk = at_row = TaskContext.get().partitionId() << 33
        for held in _gathered(batches, MEASURED_WORDS, "_text"):
            token = np.concatenate([t for _, t, _ in held])
            ends = np.cumsum([0, *[len(t) for _, t, _ in held]])
            first = np.concatenate([*[f[:-1] + at for (_, _, f), at in zip(held, ends)], ends[-1:]])
            n = len(first) - 1
            row = np.repeat(np.arange(n), np.diff(first))
            unique, where = np.unique(token, return_inverse=True)
            # the base: the most frequent words are known here
            at = np.minimum(np.searchsorted(frequent, unique), max(len(frequent) - 1, 0))
            known = frequent[at] == unique if len(frequent) else np.zeros(len(unique), bool)
            base = np.zeros(len(unique))
            base[known] = np.log10((counts[at[known]] + SMOOTHING) / floor)
            known, base = known[where], base[where]
            # levels, or the places of what has to be asked for: words first, then pairs
            both = np.append(unique, BEGIN)
            level = model.levels(both, 1)
            ask_words = np.zeros(0, U64)
            if model.lowest[0] > 1:
                ask = np.flatnonzero(level == 0)
                ask_words, place = np.unique(both[ask] >> U64(16), return_inverse=True)
                level[ask] = LEVELS + place
            level = level.astype(np.int32)
            word, context = level[where], np.empty(len(token), np.int32)
            context[1:] = word[:-1]
            context[first[:-1]] = level[-1]
            del unique, both, where
            pair, where = np.unique(pairs(token, first) >> U64(16), return_inverse=True)
            level = model.levels(pair, 2).astype(np.int32)
            ask = np.flatnonzero(level == 0)
            ask_pairs = pair[ask]
            level[ask] = LEVELS + len(ask_words) + np.arange(len(ask))
            pair = level[where]
            del level, where
            done = (word < LEVELS) & (context < LEVELS) & (pair < LEVELS)
            codes, times = _counted_codes(row[done], (context[done] * LEVELS + pair[done]) * LEVELS + word[done], n)
            begin = np.searchsorted(row[~done], np.arange(n + 1))
            others = np.searchsorted(row[~known], np.arange(n + 1))
            kept = pa.Table.from_batches([b for b, _, _ in held])
            texts = {c: kept[c].combine_chunks() for c in names} | {
                "_row": pa.array(at_row + np.arange(n)), "_chunk": pa.array(np.full(n, chunk)), "n_tokens": pa.array(np.diff(first)),
                "_known": pa.array(np.bincount(row[known], minlength=n).astype(np.int64)), "_base": pa.array(np.bincount(row, base, n)),
                "_words": kernel.lists(kernel.signed(token[~known]), others, pa.int64()), "_codes": codes, "_times": times,
                "_context": _cut_up(_narrow(context[~done]), begin), "_pair": _cut_up(pair[~done].astype(np.int32), begin), "_word": _cut_up(_narrow(word[~done]), begin),
            }
            keys = {"_chunk": [], "_gram": [], "_block": [], "_keys": []}
            for gram, asked in ((1, ask_words), (2, ask_pairs)):
                used, low, _ = counting.split(asked)
                for c, v in zip(keys, ([chunk] * len(used), [gram] * len(used), used.tolist(), low)):
                    keys[c] += v
            keys = {c: pa.array(v, TYPES[ASKING[c]]) for c, v in keys.items()}
            for columns, size in ((texts, n), (keys, len(keys["_keys"]))):
                nulls = {c: kept.schema.field(c).type for c in names} | {c: TYPES[k] for c, k in ASKING.items()}
                yield pa.RecordBatch.from_arrays([columns[c] if c in columns else pa.nulls(size, k) for c, k in nulls.items()], names=list(nulls))
            del texts, keys, columns
            chunk, at_row = chunk + 1, at_row + n
            kernel.release()

    return run


def _answer(asked: pa.Table, rest: pa.Table) -> pa.Table:
    """The levels of the keys that tasks ask a block for, 0 for those that don't occur."""
    asked = asked.select(["_chunk", "_gram", "_block", "_keys"])
    known = counting.unpacked(b"".join(rest["keys"].to_pylist()))
    order = np.argsort(known)
    known, level = known[order], np.frombuffer(b"".join(rest["levels"].to_pylist()), np.uint8)[order]
    keys = asked["_keys"].to_pylist()
    sought = counting.unpacked(b"".join(keys))
    found = np.zeros(len(sought), np.uint8)
    if len(known):
        at = np.minimum(np.searchsorted(known, sought), len(known) - 1)
        found = np.where(known[at] == sought, level[at], 0).astype(np.uint8)
    begin = np.cumsum([0, *[len(k) // 5 for k in keys]])
    return asked.drop_columns(["_keys"]).append_column("_levels", _cut_up(found, begin))


def _told(texts: pa.Table, answers: pa.Table) -> pa.Table:
    """The triples of levels of the tokens that were left open."""
    answers = answers.sort_by([("_gram", "ascending"), ("_block", "ascending")])
    level = np.concatenate([np.arange(LEVELS, dtype=np.uint8), np.frombuffer(b"".join(answers["_levels"].to_pylist()), np.uint8)]).astype(np.int64)
    parts = {c: texts[c].to_pylist() for c in ("_context", "_pair", "_word")}
    size = np.array([len(x) // 4 for x in parts["_pair"]], np.int64)
    wide = {c: len(x) and sum(map(len, x)) > size.sum() for c, x in parts.items()}
    context, pair, word = (level[np.frombuffer(b"".join(x), np.int32 if wide[c] else np.uint8)] for c, x in parts.items())
    codes, times = _counted_codes(np.repeat(np.arange(len(size)), size), (context * LEVELS + pair) * LEVELS + word, len(size))
    return pa.table({"_row": texts["_row"], "_train": texts["_train"], "_codes": codes, "_times": times})


class _Measured:
    """Texts by their triples of levels: ``texts`` what the filter told, ``told`` what the blocks did."""

    def __init__(self, docs: DataFrame, learned: tuple[Model, DataFrame], train: Column, keep: dict[str, Column], text: str):
        model, words = learned
        spark = ship(docs.sparkSession)
        shared = spark.sparkContext.broadcast((model, *frequent_words(words)))
        own = docs.select(*[c.alias(f"k{i}") for i, c in enumerate(keep.values())], train.alias("_train"), F.col(text).alias("_text"))
        self.names = [f"k{i}" for i in range(len(keep))]
        kinds = {c: own.schema[c].dataType.simpleString() for c in [*self.names, "_train"]} | ASKING
        found = cut(own.mapInArrow(_measure(shared, [*self.names, "_train"]), ", ".join(f"{c} {k}" for c, k in kinds.items())))
        self.texts = found.where("_row IS NOT NULL")
        asked = found.where("_keys IS NOT NULL").select("_chunk", "_gram", "_block", "_keys").groupBy("_gram", "_block")
        answers = asked.cogroup(model.rest.groupBy("gram", "block")).applyInArrow(_answer, "_chunk long, _gram int, _block int, _levels binary").groupBy("_chunk")
        left_open = self.texts.where("length(_pair) > 0").select("_chunk", "_row", "_train", "_context", "_pair", "_word").groupBy("_chunk")
        self.told = cut(left_open.cogroup(answers).applyInArrow(_told, "_row long, _train boolean, _codes array<int>, _times array<int>"))

    def fit(self, model: Model) -> None:
        both = self.texts.select("_train", "_codes", "_times").unionByName(self.told.drop("_row")).where("_train").select("_codes", "_times")
        t = both.mapInArrow(_totals, "code int, n long").groupBy("code").agg(F.sum("n").alias("n")).toArrow()
        model.fit(t["code"].to_numpy().astype(np.int64), t["n"].to_numpy())


def _flat(column: pa.Array) -> np.ndarray:
    return np.asarray(column.flatten()).astype(np.int64)


def _totals(batches):
    total = np.zeros(CODES)
    for batch in batches:
        total += np.bincount(_flat(batch.column("_codes")), _flat(batch.column("_times")), CODES)
    code = np.flatnonzero(total)
    yield kernel.rows(code=code.astype(np.int32), n=total[code].astype(np.int64))


def _sum_up(shared):
    """The score of each row's triples."""

    def run(batches):
        table = shared.value
        for batch in batches:
            codes = batch.column("_codes")
            size = np.asarray(codes.value_lengths()).astype(np.int64)
            score = np.bincount(np.repeat(np.arange(len(batch)), size), table[_flat(codes)] * _flat(batch.column("_times")), len(batch))
            yield kernel.rows(_row=batch.column("_row"), _score=score.astype(float))

    return run


def _scores(measured: _Measured, learned: tuple[Model, DataFrame], keep: dict[str, Column]) -> DataFrame:
    model, words = learned
    shared = words.sparkSession.sparkContext.broadcast(model.log10(np.arange(CODES)))
    both = measured.texts.select("_row", "_codes", "_times").unionByName(measured.told.drop("_train"))
    score = both.mapInArrow(_sum_up(shared), "_row long, _score double").groupBy("_row").agg(F.sum("_score").alias("score"))
    floor = model.total + SMOOTHING * (model.distinct + 1)
    each = F.coalesce((F.col("n") + SMOOTHING) / floor, F.lit(SMOOTHING / floor))
    rest = (
        measured.texts.select("_row", F.explode("_words").alias("word")).join(words, "word", "left")
        .groupBy("_row").agg(F.sum(F.log10(each)).alias("_more"), F.count("n").alias("_found"))
    )
    return measured.texts.select("_row", *measured.names, "n_tokens", "_known", "_base").join(score, "_row").join(rest, "_row", "left").select(
        *[F.col(c).alias(n) for c, n in zip(measured.names, keep)], "n_tokens", (F.col("_known") + F.coalesce("_found", F.lit(0))).alias("n_known"),
        F.lit(model.total).cast("long").alias("train_tokens"), (F.col("_base") + F.coalesce("_more", F.lit(0.0))).alias("base_score"), "score",
    )


def learn(train: DataFrame, text: str = "text") -> tuple[Model, DataFrame]:
    """The model, and the exact counts (word, n) of the training tokens."""
    learned = _count(train, text)
    _Measured(train, learned, F.lit(True), {}, text).fit(learned[0])
    return learned


def _salted(batches):
    for batch in batches:
        keys = np.asarray(batch.column("key")).view(U64) + np.asarray(batch.column("gram")).astype(U64)
        yield kernel.rows(key=kernel.signed(kernel.mix(keys)), low=batch.column("low"), high=batch.column("high"))


def lowest_levels(kinds: np.ndarray) -> list[int]:
    """The lowest level of words and pairs in the filter, so that what is added fits it; the blocks answer for
    the levels below."""
    low = [1, 2]
    while (words := counting.load(kinds[0], low[0])) + (both := counting.load(kinds[1], low[1])) > CAPACITY:
        low[1 if both > CAPACITY // 2 or words <= CAPACITY // 2 else 0] += 1
    return low


def frequent_words(words: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """At most FREQUENT words with the highest counts, sorted by hash, and their counts."""
    fine = F.floor(F.log2("n") * 16)
    histogram = sorted(words.groupBy(fine.alias("f")).agg(F.count("*").alias("k")).collect(), key=lambda r: -r.f)
    left, lowest = FREQUENT, None
    for r in histogram:
        left -= r.k
        if left < 0:
            break
        lowest = r.f
    if lowest is None:
        return np.zeros(0, U64), np.zeros(0)
    top = words.where(fine >= lowest).toArrow()
    keys = top["word"].to_numpy().view(U64)
    order = np.argsort(keys)
    return keys[order], top["n"].to_numpy()[order].astype(float)


def score(docs: DataFrame, learned: tuple[Model, DataFrame], keep: dict[str, Column], text: str = "text") -> DataFrame:
    """One row per document: the columns of ``keep`` and n_tokens, n_known, train_tokens, base_score,
    score (log10 probabilities of the whole text and its end).

    A null text counts as empty and consists of its end alone; rows are answered one by one,
    repeated ones too; an empty training set gives counts of 0, a base score of 0 per token and
    the same smoothed probability for every word. Words are told apart by 64-bit hashes."""
    return _scores(_Measured(docs, learned, F.lit(False), keep, text), learned, keep)


def learn_and_score(docs: DataFrame, train: Column, keep: dict[str, Column], text: str = "text") -> DataFrame:
    """``score`` of all rows by a model of those where ``train`` holds; each text is measured once."""
    learned = _count(docs.where(train), text)
    measured = _Measured(docs, learned, train, keep, text)
    measured.fit(learned[0])
    return _scores(measured, learned, keep)


NAME = "op6_bloom_language_model"
SQL = None


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = is_fold("doc_id", 10, 0)
    return learn_and_score(docs, ~held_out, {"doc_id": F.col("doc_id"), "held_out": held_out})
