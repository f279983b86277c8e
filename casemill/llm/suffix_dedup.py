"""Removal of repeated byte strings with suffix arrays.

Every byte goes that is covered by a string of ``LENGTH`` bytes which starts anywhere else as well.

A window of ``LENGTH`` bytes belongs to the smallest hash among its grams (its anchor); equal
windows have equal anchors, so windows that don't share their anchor's gram with another anchor
are unique. Consecutive windows with one anchor form a context. The steps are

1. count the anchors' grams over all rows; the repeated ones go into a Bloom filter, which only
   spares shuffling (what passes it is counted again, exactly);
2. count (gram, context). A context that occurs twice is repeated as a whole. One that occurs
   once while its gram has other contexts may be repeated in part;
3. those contexts, and one sample of each repeated one, are dealt out by gram, and each deal is
   sorted as a suffix array in two stages: suffixes smaller than their successors are sorted
   directly, the others are induced by scanning the buckets from the smallest character up.
   Adjacent suffixes with a common prefix of ``LENGTH`` are repeated windows.

Grams with more than ``GROUP`` contexts are split by longer grams, up to whole windows, before
anything is sorted, so no gram meets in one task however common it is.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bitfilter, kernel
from .tables import cut, forget, ship, table

LENGTH = 200
#: Gram sizes as shares of the window: the first for all texts, longer ones for crowded grams.
GRAMS = (0.32, 0.66, 0.83, 1.0)
GROUP = 2048
#: Bytes of contexts sorted together.
DEAL_BYTES = 1 << 20
FILTER_BITS, PROBES = 27, 4
SEGMENT = 1 << 18
U64 = np.uint64


# -- anchors -------------------------------------------------------------------------------------


def segments(column: pa.Array, length: int):
    """(first row, bytes, row offsets, base) pieces of bounded size. A longer text comes in pieces
    that overlap by ``length - 1`` bytes, so each window is in exactly one; base is its place."""
    for lo, _, data, offsets in kernel.chunks(column, SEGMENT):
        if len(data) <= 2 * SEGMENT:
            yield lo, data, offsets, 0
            continue
        for base in range(0, len(data), SEGMENT):
            piece = data[base : base + SEGMENT + length - 1]
            yield lo, piece, np.array([0, len(piece)]), base


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """The minimum of each run of ``width`` values."""
    span, out = 1, values
    while span * 2 <= width:
        out = np.minimum(out[:-span], out[span:])
        span *= 2
    rest = width - span
    return np.minimum(out[: len(out) - rest], out[rest:]) if rest else out


def anchors(data: np.ndarray, offsets: np.ndarray, length: int, gram: int):
    """(row, first window, last window, gram hash, context hash) of each context, places being
    those in ``data``."""
    none = np.zeros(0, np.int64)
    if len(data) < length:
        return none, none, none, none.astype(U64), none.astype(U64)
    prefix = kernel.rolling(data)
    n = len(data) - gram + 1
    # kernel.span_hash of every gram
    hashes = kernel.mix((prefix[gram:] - prefix[:n]) * kernel.powers(n)[1] + np.full(1, gram, U64) * kernel.BASE)
    bits = U64(max(1, int(len(data)).bit_length()))
    # the smallest hash wins and the leftmost of equals
    least = sliding_min((hashes >> bits << bits) | np.arange(n, dtype=U64), length - gram + 1)
    place = (least & ((U64(1) << bits) - U64(1))).astype(np.int64)
    fresh = np.ones(len(place), bool)
    fresh[1:] = place[1:] != place[:-1]
    fresh[offsets[:-1][np.diff(offsets) >= length]] = True
    lo = np.flatnonzero(fresh)
    row = np.searchsorted(offsets, lo, "right") - 1
    last = offsets[row + 1] - length  # the row's last window
    hi = np.minimum(np.append(lo[1:], len(place)) - 1, last)
    whole = lo <= last
    row, lo, hi = row[whole], lo[whole], hi[whole]
    at = place[lo]
    context = kernel.span_hash(prefix, lo, hi + length) + (at - lo).astype(U64)
    return row, lo, hi, hashes[at], kernel.mix(context)


def place_key(gram: np.ndarray, rid: np.ndarray, lo: np.ndarray) -> np.ndarray:
    return kernel.mix(gram.view(U64) ^ kernel.mix(rid.view(U64) + lo.astype(U64)))


def _grams(length, gram):
    def run(batches):
        for batch in batches:
            for _, data, offsets, _ in segments(batch.column("text"), length):
                keys, count = np.unique(anchors(data, offsets, length, gram)[3], return_counts=True)
                yield kernel.rows(key=kernel.signed(keys), n=count)

    return run


def _anchored(length, gram, shared):
    """Anchors whose gram passes the filter."""

    def run(batches):
        filter_ = np.frombuffer(shared.value, np.uint8)
        for batch in batches:
            rid = np.asarray(batch.column("rid"))
            for first, data, offsets, base in segments(batch.column("text"), length):
                row, lo, hi, key, context = anchors(data, offsets, length, gram)
                ok = bitfilter.contains(filter_, key, FILTER_BITS, PROBES)
                row, lo, hi = row[ok], lo[ok], hi[ok]
                back = base - offsets[row]
                yield kernel.rows(gram=kernel.signed(key[ok]), context=kernel.signed(context[ok]), rid=rid[first + row], lo=lo + back, hi=hi + back)

    return run


def _contexts(length, gram, shared):
    """The bytes of the contexts whose place passes the filter."""

    def run(batches):
        filter_ = np.frombuffer(shared.value, np.uint8)
        for batch in batches:
            rid = np.asarray(batch.column("rid"))
            for first, data, offsets, base in segments(batch.column("text"), length):
                row, lo, hi, key, _ = anchors(data, offsets, length, gram)
                back, ids = base - offsets[row], rid[first + row]
                ok = np.flatnonzero(bitfilter.contains(filter_, place_key(key, ids, lo + back), FILTER_BITS, PROBES))
                raw = data.tobytes()
                yield kernel.rows(
                    gram=kernel.signed(key[ok]), rid=ids[ok], lo=(lo + back)[ok], hi=(hi + back)[ok],
                    data=kernel.binaries([raw[a : b + length] for a, b in zip(lo[ok], hi[ok])]),
                )

    return run


def _sub_contexts(length, gram):
    """Anchors by a longer gram inside given contexts."""

    def run(batches):
        for batch in batches:
            data = batch.column("data").to_pylist()
            rid, base = np.asarray(batch.column("rid")), np.asarray(batch.column("lo"))
            for at in range(0, len(data), 1024):
                part = data[at : at + 1024]
                offsets = np.concatenate([[0], np.cumsum([len(d) for d in part])]).astype(np.int64)
                raw = b"".join(part)
                row, lo, hi, key, context = anchors(np.frombuffer(raw, np.uint8), offsets, length, gram)
                back = base[at + row] - offsets[row]
                yield kernel.rows(
                    gram=kernel.signed(key), context=kernel.signed(context), rid=rid[at + row], lo=lo + back, hi=hi + back,
                    data=kernel.binaries([raw[a : b + length] for a, b in zip(lo, hi)]),
                )

    return run


# -- suffix arrays -------------------------------------------------------------------------------


def _words(text: np.ndarray) -> np.ndarray:
    """The 8 bytes from each place on as one number; zeros follow the end."""
    padded = np.concatenate([text, np.zeros(8, np.uint8)]).astype(U64)
    out = np.zeros(len(text), U64)
    for k in range(8):
        out = (out << U64(8)) | padded[k : k + len(text)]
    return out


def _word_at(words: np.ndarray, at: np.ndarray) -> np.ndarray:
    out = np.zeros(len(at), U64)
    inside = at < len(words)
    out[inside] = words[at[inside]]
    return out


def sort_directly(words: np.ndarray, suffixes: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes in the order of their first ``depth`` bytes (rounded up to whole words)."""
    known, rank = np.unique(words, return_inverse=True)
    rank += known[0] != 0  # 0 is what follows the end
    order = suffixes[np.argsort(rank[suffixes])]
    key = rank[order]
    group = np.concatenate([[0], np.cumsum(key[1:] != key[:-1])]) if len(order) else np.zeros(0, np.int64)
    for at in range(8, depth, 8):
        sizes = np.bincount(group)
        tied = np.flatnonzero(sizes[group] > 1)
        if not len(tied):
            break
        # one number of the group so far and the next word's rank
        place = order[tied] + at
        inside = place < len(rank)
        key = group[tied] << 32
        key[inside] |= rank[place[inside]]
        by = np.argsort(key)
        order[tied], key = order[tied][by], key[by]
        step = np.zeros(len(group), np.int64)
        step[1:] = group[1:] != group[:-1]
        step[tied[1:][(key[1:] != key[:-1]) & (key[1:] >> 32 == key[:-1] >> 32)]] = 1
        group = np.cumsum(step)
    return order


def suffix_array(text: np.ndarray, depth: int) -> np.ndarray:
    """All suffixes ordered by their first ``depth`` bytes at least.

    Stage one sorts the suffixes that are smaller than their successors. Stage two goes through
    the buckets of first characters from the smallest up: a suffix whose first character isn't
    smaller than the next stands in its bucket in the order of its successors, so each bucket's
    finished part tells the order of larger ones. The end of the text is smaller than any byte.
    """
    n = len(text)
    if not n:
        return np.zeros(0, np.int64)
    words = _words(text)
    sign = np.append(np.sign(text[1:].astype(np.int16) - text[:-1].astype(np.int16)), -1)
    differs = np.where(sign != 0, np.arange(n), n - 1)
    nearest = np.minimum.accumulate(differs[::-1])[::-1]
    smaller = sign[nearest] > 0
    direct = sort_directly(words, np.flatnonzero(smaller), depth)
    first = text[direct]
    induced: list[list[np.ndarray]] = [[] for _ in range(256)]
    induced[text[n - 1]].append(np.array([n - 1]))
    out = []
    for c in range(256):
        front = np.concatenate(induced[c]) if induced[c] else np.zeros(0, np.int64)
        parts = []
        while len(front):
            parts.append(front)
            before = front[front > 0] - 1
            front = before[text[before] == c]
        lo, hi = np.searchsorted(first, c), np.searchsorted(first, c, "right")
        bucket = np.concatenate([*parts, direct[lo:hi]])
        if not len(bucket):
            continue
        out.append(bucket)
        before = bucket[bucket > 0] - 1
        chars = text[before]
        larger = chars > c
        before, chars = before[larger], chars[larger]
        order = np.argsort(chars, kind="stable")
        cuts = np.flatnonzero(np.diff(chars[order])) + 1
        for part in np.split(before[order], cuts):
            if len(part):
                induced[text[part[0]]].append(part)
    return np.concatenate(out)


def adjacent_prefix(text: np.ndarray, order: np.ndarray, limit: int) -> np.ndarray:
    """True where a suffix and the one before it agree in ``limit`` bytes; the first is False."""
    words = _words(text)
    equal = np.zeros(len(order), bool)
    alive = np.arange(1, len(order))
    for at in range(0, limit, 8):
        a, b = order[alive] + at, order[alive - 1] + at
        x = _word_at(words, a) ^ _word_at(words, b)
        x >>= U64(8 * max(0, at + 8 - limit))
        alive = alive[x == 0]
    equal[alive] = True
    return equal


def _sorted(length):
    def run(table_: pa.Table) -> pa.Table:
        rid, lo = np.asarray(table_["rid"]), np.asarray(table_["lo"])
        data = table_["data"].to_pylist()
        _, keep = np.unique(np.stack([rid, lo]), axis=1, return_index=True)  # repeated rows
        spans = {"rid": [], "lo": [], "end": []}
        sizes = np.cumsum([len(data[i]) for i in keep])
        if len(keep):
            text = np.frombuffer(b"".join(data[i] for i in keep), np.uint8)
            start = np.concatenate([[0], sizes[:-1]])
            order = suffix_array(text, length)
            owner = np.searchsorted(sizes, order, "right")
            whole = sizes[owner] - order >= length  # windows of their own context
            order, owner = order[whole], owner[whole]
            equal = adjacent_prefix(text, order, length)
            repeated = equal | np.append(equal[1:], False)
            at, own = order[repeated], owner[repeated]
            by = np.argsort(at)
            at, own = at[by], own[by]
            if len(at):
                head = np.ones(len(at), bool)
                head[1:] = (at[1:] != at[:-1] + 1) | (own[1:] != own[:-1])
                first = np.flatnonzero(head)
                last = np.append(first[1:], len(at)) - 1
                base = lo[keep[own[first]]] - start[own[first]]
                spans = {"rid": rid[keep[own[first]]], "lo": at[first] + base, "end": at[last] + base + length}
        return pa.table({k: pa.array(v, pa.int64()) for k, v in spans.items()})

    return run


# -- repeated contexts ---------------------------------------------------------------------------


def context_key(gram: np.ndarray, context: np.ndarray) -> np.ndarray:
    return kernel.mix(gram.view(U64) ^ kernel.mix(context.view(U64)))


def _context_keys(batches):
    for batch in batches:
        gram, context = (np.asarray(batch.column(c)) for c in ("gram", "context"))
        yield kernel.rows(key=kernel.signed(context_key(gram, context)))


def _passing(shared, batch) -> np.ndarray:
    filter_ = np.frombuffer(shared.value, np.uint8)
    gram, context = (np.asarray(batch.column(c)) for c in ("gram", "context"))
    return np.flatnonzero(bitfilter.contains(filter_, context_key(gram, context), FILTER_BITS, PROBES))


def _by_text(shared, length):
    """The places whose context passes the filter as ``rid``, ``los`` and ``ends``, a text's places that
    follow one another in one row."""

    def run(batches):
        for batch in batches:
            ok = _passing(shared, batch)
            rid, lo, hi = (np.asarray(batch.column(c))[ok] for c in ("rid", "lo", "hi"))
            first = np.flatnonzero(np.append(True, rid[1:] != rid[:-1])) if len(rid) else np.zeros(0, np.int64)
            offsets = np.append(first, len(rid))
            yield kernel.rows(rid=rid[first], los=kernel.lists(lo, offsets, pa.int64()), ends=kernel.lists(hi + length, offsets, pa.int64()))

    return run


def _passed_by_chance(shared):
    """Of contexts that occur once, the places of those that pass the filter."""

    def run(batches):
        for batch in batches:
            ok = pa.array(_passing(shared, batch))
            yield kernel.rows(rid=batch.column("rid").take(ok), lo=batch.column("lo").take(ok))

    return run


def _without(batches):
    """Spans of the places that aren't among ``wrong``, those that overlap or touch made one."""
    for batch in batches:
        rids, los, ends, wrongs = (batch.column(c).to_pylist() for c in ("rid", "los", "ends", "wrong"))
        out = []
        for rid, lo, end, wrong in zip(rids, los, ends, wrongs):
            gone = set(wrong or ())
            out += [(rid, a, b) for a, b in merged([(a, b) for a, b in zip(lo, end) if a not in gone])]
        yield kernel.rows(**{c: pa.array([r[k] for r in out], pa.int64()) for k, c in enumerate(("rid", "lo", "end"))})


# -- the operator --------------------------------------------------------------------------------

SPANS = "rid long, lo long, end long"


def _classified(found: DataFrame, length: int) -> tuple[DataFrame, DataFrame]:
    """Spans of the contexts that occur twice; and (gram, rid, lo, crowd) of those to be sorted,
    crowd being the gram's number of contexts. Both are written, so that the filter can go.

    The places of a repeated context aren't gathered: the contexts go into a Bloom filter, a text's
    places that pass it are one row, and those that pass by chance, which occur once and are
    known by place, are taken out again."""
    spark = found.sparkSession
    places = F.struct("rid", "lo", "hi")
    by_context = found.groupBy("gram", "context").agg(F.count("*").alias("n"), F.min(places).alias("place"))
    by_context = cut(by_context)
    by_gram = by_context.groupBy("gram").agg(F.count("*").alias("crowd"), F.count_if(F.col("n") == 1).alias("single"))
    keys = by_context.where("n > 1").select("gram", "context").mapInArrow(_context_keys, "key long")
    with bitfilter.shared(spark, bitfilter.build(keys, FILTER_BITS, PROBES).tobytes()) as shared:
        once = by_context.where("n = 1").select("gram", "context", "place.rid", "place.lo")
        wrong = once.mapInArrow(_passed_by_chance(shared), "rid long, lo long").groupBy("rid").agg(F.collect_set("lo").alias("wrong"))
        passing = found.select("gram", "context", "rid", "lo", "hi").mapInArrow(_by_text(shared, length), "rid long, los array<long>, ends array<long>")
        spans = cut(passing.join(wrong, "rid", "left").mapInArrow(_without, SPANS))
    open_ = by_context.join(by_gram.where("crowd > 1 AND single > 0"), "gram")
    open_ = cut(open_.select("gram", "place.rid", "place.lo", "crowd"))
    forget(by_context)
    return spans, open_


def spans(rows: DataFrame, length: int = LENGTH) -> DataFrame:
    """(rid, lo, end) byte ranges of repeated strings; ranges may overlap and repeat.

    ``rows`` has the columns rid (long, the same for equal rows only) and text."""
    spark = ship(rows.sparkSession)
    grams = [max(8, min(length, round(g * length))) for g in GRAMS]
    gram, deeper = grams[0], sorted({g for g in grams if g > grams[0]})
    counted = rows.select("text").mapInArrow(_grams(length, gram), "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))
    with bitfilter.shared(spark, bitfilter.build(counted.where("n > 1"), FILTER_BITS, PROBES).tobytes()) as filter_:
        found = cut(rows.mapInArrow(_anchored(length, gram, filter_), "gram long, context long, rid long, lo long, hi long"))
    whole, open_ = _classified(found, length)
    forget(found)
    parts = [whole]
    keys = open_.mapInArrow(_place_keys, "key long")
    with bitfilter.shared(spark, bitfilter.build(keys, FILTER_BITS, PROBES).tobytes()) as wanted:
        contexts = rows.mapInArrow(_contexts(length, gram, wanted), "gram long, rid long, lo long, hi long, data binary")
        todo = cut(contexts.join(open_, ["gram", "rid", "lo"]))
    forget(open_)
    while True:
        small = todo.where(F.col("crowd") <= GROUP)
        volume = todo.agg(F.sum(F.when(F.col("crowd") <= GROUP, F.octet_length("data"))).alias("small"), F.count_if(F.col("crowd") > GROUP).alias("large")).first()
        if volume.small:
            deals = max(1, -(-volume.small // DEAL_BYTES))
            dealt = small.select(F.pmod(F.xxhash64("gram"), F.lit(deals)).alias("deal"), "rid", "lo", "data")
            parts.append(cut(dealt.groupBy("deal").applyInArrow(_sorted(length), SPANS)))
        if not volume.large or not deeper:
            break
        crowded = todo.where(F.col("crowd") > GROUP).dropDuplicates(["gram", "rid", "lo"])
        found = cut(crowded.mapInArrow(_sub_contexts(length, deeper.pop(0)), "gram long, context long, rid long, lo long, hi long, data binary"))
        whole, open_ = _classified(found, length)
        parts.append(whole)
        before, todo = todo, cut(found.drop("context").join(open_, ["gram", "rid", "lo"]))
        forget(before, found, open_)
    forget(todo)
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def _place_keys(batches):
    for batch in batches:
        gram, rid, lo = (np.asarray(batch.column(c)) for c in ("gram", "rid", "lo"))
        yield kernel.rows(key=kernel.signed(place_key(gram, rid, lo)))


def merged(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Sorted ranges, those that overlap or touch made one."""
    out: list[tuple[int, int]] = []
    for lo, end in sorted(ranges):
        if out and lo <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((lo, end))
    return out


def _apply(names):
    def run(batches):
        for batch in batches:
            texts = kernel.as_text(batch.column("_text")).cast(pa.binary()).to_pylist()
            ranges = batch.column("_ranges").to_pylist()
            kept, size, removed, count, digest = [], [], [], [], []
            for text, spans_ in zip(texts, ranges):
                runs = merged([(s["lo"], s["end"]) for s in spans_ or ()])
                edges = [0, *[x for run_ in runs for x in run_], len(text)]
                rest = b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2]))
                kept.append(rest)
                size.append(len(text))
                removed.append(len(text) - len(rest))
                count.append(len(runs))
                digest.append(hashlib.sha256(rest).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in names]
                + [kernel.binaries(kept), pa.array([k.decode("utf-8", "ignore") for k in kept], pa.string()), *(pa.array(x, pa.int64()) for x in (size, removed, count)), pa.array(digest, pa.string())],
                names=[*names, "kept", "kept_text", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
            )

    return run


def remove(docs: DataFrame, keep: dict[str, Column], id_column: str = "doc_id", text: str = "text", length: int = LENGTH) -> DataFrame:
    """One row per document: the columns of ``keep`` and kept (binary), kept_text (without the
    remains of cut characters), n_bytes, n_removed, n_spans, kept_sha256.

    Texts are taken as UTF-8 bytes, null as empty. Places are judged on the input: all places of a
    repeated string lose it, those in one document too, and overlaps count. Texts shorter than
    ``length`` stay whole. Rows that are alike in id and text count as two places; null ids are
    ids like any other. Nothing is removed from an empty table. Texts and grams are compared by
    64-bit hashes on the way; whether two windows are equal is decided on bytes or on a 64-bit
    hash of the whole context."""
    rid = F.xxhash64(F.col(id_column), F.col(text))
    rows = docs.select(rid.alias("rid"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    ranges = spans(rows, length).groupBy("rid").agg(F.collect_set(F.struct("lo", "end")).alias("_ranges"))
    own = docs.select(rid.alias("rid"), F.col(text).alias("_text"), *[c.alias(f"k{i}") for i, c in enumerate(keep.values())])
    names = [f"k{i}" for i in range(len(keep))]
    kinds = ", ".join(f"{c} {own.schema[c].dataType.simpleString()}" for c in names)
    out = own.join(ranges, "rid", "left").drop("rid").mapInArrow(
        _apply(names), f"{kinds}, kept binary, kept_text string, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    )
    return out.select(*[F.col(c).alias(n) for c, n in zip(names, keep)], "kept", "kept_text", "n_bytes", "n_removed", "n_spans", "kept_sha256")


NAME = "op10_suffix_array_dedup"
SQL = None


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove(table(spark, sf_dir, "documents"), {"doc_id": F.col("doc_id")}).drop("kept", "kept_text")


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents without their repeated passages; n_chars follows the text."""
    own = {c: F.col(f"`{c}`") for c in docs.columns if c not in ("text", "n_chars")}
    rest = remove(docs, own | {"_null": F.col("text").isNull()})
    text = F.when(~F.col("_null"), F.col("kept_text"))
    new = {"text": text, "n_chars": F.length(text).cast("long")}
    return rest.select(*[(new[c] if c in new else F.col(f"`{c}`")).alias(c) for c in docs.columns])
