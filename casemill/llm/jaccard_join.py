"""Exact Jaccard join of word-shingle sets with token-combination prefixes.

Sets that are equal are one class from the start. For two different sets x and y with a Jaccard
similarity of at least t, x lacks at most floor((1 - t) * |x|) of its tokens in y. Tokens are put
in one order for all sets, rare ones first, and x is indexed under signatures of a prefix:

* a rare token is a signature alone;
* frequent tokens fall into subclasses by hash, and every pair of one subclass is a signature.

A prefix that shares no signature with y has lost all its rare tokens and, in every subclass, all
but one; so it is extended until rare tokens + sum over subclasses (size - 1) exceeds what x may
lack. Then every similar pair shares a signature. The number of subclasses follows the set's size
(one for 16 to 32 tokens); sets near the border of two sizes are indexed for both, so that sets
that may be similar always have one in common. The order comes from exact counts of all tokens,
whose logarithms are broadcast as a Bloom filter of fixed size: false positives cost time only,
never results. Tokens that occur once match nothing and are no signatures.

A signature's sets are a list of candidates, cut into blocks if it is long. Within a list, parity
bitmaps give a lower bound of the symmetric difference that rules out nearly all pairs that aren't
similar. Of the rest a spanning forest is proposed and its edges are verified on the true sets.
First every set asks in its longest list only. What that connects is one part in all lists; lists
with several parts left propose pairs between them, each pair in one list alone, the one with the
smallest of the signatures both sets have. Lists with refuted edges, or with a member that had
more to propose than it may at once, propose again without the answered ones, several for each
member, until nothing new comes up. So neither all pairs of a large group of copies nor one
pair's many lists are written out, and no link that holds two parts together is lost.
"""

from __future__ import annotations

from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bitfilter, counting, kernel
from .components import components
from .tables import cut, forget, ship, table, temporary_cuts

FILTER_BITS, PROBES = 28, 4
CAPACITY = (1 << FILTER_BITS) // 10
#: Tokens of this level, from 2**(FREQUENT - 1) occurrences on, are frequent.
FREQUENT = 7
FLUSH_TOKENS = 1 << 20
PER_SUBCLASS = 16
BITMAP_BITS = 2048
#: Sets of a candidate list that are compared in one piece.
BLOCK = 2048
U64 = np.uint64


# -- sets ----------------------------------------------------------------------------------------


def sets_of(column: pa.Array, words: int):
    """(row, sorted distinct shingle hashes) of each text."""
    for lo, hi, data, offsets in kernel.chunks(column):
        hashes, first = kernel.word_hashes(kernel.lower(data), offsets)
        for r in range(hi - lo):
            yield lo + r, kernel.shingles(hashes[first[r] : first[r + 1]], words)


def set_id(tokens: np.ndarray) -> int:
    """A 64-bit name of a set, the same for equal sets."""
    a = kernel.mix(tokens).sum(dtype=U64)
    b = np.bitwise_xor.reduce(kernel.mix(tokens + U64(0x5851F42D4C957F2D)))
    return int(kernel.mix(np.array([a ^ kernel.mix(np.array([b + U64(len(tokens))]))[0]]))[0].astype(np.int64))


def _counted(words: int):
    def tokens(batches):
        held, size = [], 0
        for batch in batches:
            for _, some in sets_of(batch.column("text"), words):
                held.append(some)
                size += len(some)
                if size >= FLUSH_TOKENS:
                    yield np.concatenate(held)
                    held, size = [], 0
        if held:
            yield np.concatenate(held)

    return lambda batches: counting.packed(tokens(batches))


def frequencies(docs: DataFrame, words: int) -> tuple[bytes, int]:
    """The log-frequency filter over the tokens of all rows, and its lowest stored level."""
    counts = cut(counting.seen_again(docs.select("text"), _counted(words)).withColumn("high", counting.level("n")))
    kinds = np.zeros(counting.LEVELS)
    for r in counts.groupBy("high").agg(F.count("*").alias("k")).collect():
        kinds[r.high] = r.k
    low = 2
    while counting.load(kinds, low) > CAPACITY:
        low += 1
    stored = counts.where(F.col("high") >= low).select("key", F.lit(low).alias("low"), "high")
    bits = bitfilter.build(stored, FILTER_BITS, PROBES).tobytes()
    forget(counts)
    return bits, low


# -- signatures ----------------------------------------------------------------------------------


def lacking(n: int, threshold: Fraction) -> int:
    """How many of n tokens a set may lack in a similar one."""
    return int((1 - threshold) * n)


def may_have_partner(n: int, threshold: Fraction) -> bool:
    """Whether a set of n tokens can be similar to a different one."""
    return int(n / threshold) > n or lacking(n, threshold) > 0


def subclass_counts(n: int, threshold: Fraction) -> list[int]:
    """For each size a similar set may have, the number of subclasses of that size's class."""
    low, high = max(1, -(-n * threshold.numerator // threshold.denominator)), int(n / threshold)
    return sorted({max(1, 1 << (size.bit_length() - 1) >> PER_SUBCLASS.bit_length() - 1) for size in (low, n, high)})


def signatures(tokens: np.ndarray, level: np.ndarray, threshold: Fraction, lowest: int) -> np.ndarray:
    """Distinct signature hashes of a set; ``level`` are its tokens' logarithmic counts."""
    n = len(tokens)
    need = lacking(n, threshold) + 1
    order = np.lexsort((tokens, level))
    tokens, level = tokens[order], level[order]
    n_rare = int(np.searchsorted(level, FREQUENT))
    # with all levels stored, level 0 means that the token occurs nowhere else
    alone = int(np.searchsorted(level, 1)) if lowest == 2 else 0
    rare = tokens[alone : min(n_rare, need)]
    if n_rare >= need:
        return rare
    found = [rare]
    common = tokens[n_rare:]
    for classes in subclass_counts(n, threshold):
        # extend the prefix by frequent tokens until enough are covered
        own = (kernel.mix(common) % U64(classes)).astype(np.int64)
        by = np.argsort(own, kind="stable")
        again = np.zeros(len(common), bool)
        again[by[1:]] = own[by][1:] == own[by][:-1]
        covered = np.cumsum(again)
        end = int(np.searchsorted(covered, need - n_rare)) + 1
        if end > len(common):
            raise ValueError("the threshold is too low for token combinations")
        prefix, own = common[:end], own[:end]
        by = np.argsort(own, kind="stable")
        prefix, own = prefix[by], own[by]
        starts = np.flatnonzero(np.append(True, own[1:] != own[:-1]))
        for a, b in zip(starts, np.append(starts[1:], end)):
            i, j = np.triu_indices(b - a, 1)
            x, y = prefix[a:b][i], prefix[a:b][j]
            found.append(kernel.mix(kernel.mix(np.minimum(x, y)) + np.maximum(x, y) + U64(classes)))
    return np.unique(np.concatenate(found))


def bitmap(tokens: np.ndarray) -> bytes:
    """Per cell, whether an odd number of tokens falls into it."""
    odd = np.bincount((kernel.mix(tokens) & U64(BITMAP_BITS - 1)).astype(np.int64), minlength=BITMAP_BITS) & 1
    return np.packbits(odd.astype(np.uint8)).tobytes()


def _facts(words: int):
    def run(batches):
        for batch in batches:
            rows = [(r, len(t), set_id(t) if len(t) else None) for r, t in sets_of(batch.column("text"), words)]
            own = [c for c in batch.schema.names if c != "text"]
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in own] + [pa.array([n for _, n, _ in rows], pa.int64()), pa.array([s for _, _, s in rows], pa.int64())],
                names=[*own, "n", "sid"],
            )

    return run


def _signed(words: int, threshold: Fraction, lowest: int, shared):
    def flush(held):
        if not held:
            return _posted([], [])
        filter_ = np.frombuffer(shared.value, np.uint8)
        level = counting.levels(filter_, FILTER_BITS, PROBES, np.concatenate(held) >> U64(16), lowest)
        parts = np.split(level, np.cumsum([len(t) for t in held])[:-1])
        return _posted([signatures(t, q, threshold, lowest) for t, q in zip(held, parts)], [set_id(t) for t in held])

    def run(batches):
        held, size = [], 0
        for batch in batches:
            for _, tokens in sets_of(batch.column("text"), words):
                if len(tokens) and may_have_partner(len(tokens), threshold):
                    held.append(tokens)
                    size += len(tokens)
                if size > 1 << 18:
                    yield flush(held)
                    held, size = [], 0
        yield flush(held)

    return run


def _posted(found, sids) -> pa.RecordBatch:
    sig = np.concatenate(found) if found else np.zeros(0, U64)
    return kernel.rows(sig=kernel.signed(sig), sid=pa.array(np.repeat(np.array(sids, np.int64), [len(f) for f in found]), pa.int64()))


def _described(words: int):
    """The true sets and their bitmaps, for texts that are candidates."""

    def run(batches):
        for batch in batches:
            sids, sets = batch.column("sid"), {r: t for r, t in sets_of(batch.column("text"), words)}
            tokens = [sets[r] for r in range(len(batch))]
            offsets = np.concatenate([[0], np.cumsum([len(t) for t in tokens])])
            flat = np.concatenate(tokens) if tokens else np.zeros(0, U64)
            yield kernel.rows(
                sid=sids, n=pa.array([len(t) for t in tokens], pa.int32()), bits=kernel.binaries([bitmap(t) for t in tokens]),
                tokens=kernel.lists(kernel.signed(flat), offsets, pa.int64()),
            )

    return run


# -- candidate lists -----------------------------------------------------------------------------

def proposals(sids, sizes, bits, threshold, linked, refuted, width, parts=None, asking=None, mine=None) -> tuple[list[tuple[int, int]], bool]:
    """Pairs that may be similar and would connect what isn't connected by linked pairs, and whether
    pairs of that kind were held back.

    A ``width`` of 1 asks for a spanning forest, which holds nothing back if all its edges verify, a
    larger one for so many pairs for each member. ``parts``: a label for each member, equal for
    those that are connected. ``asking``: members for which pairs are wanted, instead of all.
    ``mine(i, j)``: whether a pair may be proposed here."""
    place = {s: i for i, s in enumerate(sids)}
    label = np.arange(len(sids)) if parts is None else np.unique(parts, return_inverse=True)[1]
    for a, b in linked:
        x, y = label[place[a]], label[place[b]]
        label[label == max(x, y)] = min(x, y)
    no: dict[int, set[int]] = {}
    for a, b in refuted:
        i, j = sorted((place[a], place[b]))
        no.setdefault(j, set()).add(i)
    words = bits.view(U64)
    up, down = threshold.numerator, threshold.denominator
    out, more = [], False
    for i in range(1, len(sids)) if asking is None else np.flatnonzero(asking).tolist():
        others = np.flatnonzero(label[:i] != label[i])
        if asking is not None:
            others = np.append(others, i + np.flatnonzero((label[i:] != label[i]) & ~asking[i:]))
        small, large = np.minimum(sizes[others], sizes[i]), np.maximum(sizes[others], sizes[i])
        others = others[small * down >= large * up]
        if not len(others):
            continue
        apart = np.bitwise_count(words[others] ^ words[i]).sum(1).astype(np.int64)
        both = sizes[others] + sizes[i]
        # overlap <= (both - apart) / 2 and union >= (both + apart) / 2
        others = others[(both - apart) * down >= (both + apart) * up]
        left = width
        for j in others.tolist():
            if j in no.get(i, ()) or (width == 1 and label[i] == label[j]) or (mine is not None and not mine(i, j)):
                continue
            if not left:
                more = True
                break
            out.append((i, j))
            if width == 1:
                x, y = label[i], label[j]
                label[label == max(x, y)] = min(x, y)
            else:
                left -= 1
    return [(int(min(sids[a], sids[b])), int(max(sids[a], sids[b]))) for a, b in out], more


def _members(table_: pa.Table):
    """Order by name, names, sizes and bitmaps of a list's members."""
    sids = np.asarray(table_["sid"])
    order = np.argsort(sids)
    bits = np.frombuffer(b"".join(table_["bits"].to_pylist()), np.uint8).reshape(len(sids), -1)[order]
    return order, sids[order].tolist(), np.asarray(table_["n"])[order].astype(np.int64), np.ascontiguousarray(bits)


def _first(threshold: Fraction):
    def run(members: pa.Table) -> pa.Table:
        order, sids, sizes, bits = _members(members)
        found, _ = proposals(sids, sizes, bits, threshold, (), (), 1, asking=np.asarray(members["own"])[order])
        return pa.table({"a": pa.array([a for a, _ in found], pa.int64()), "b": pa.array([b for _, b in found], pa.int64())})

    return run


def _propose(threshold: Fraction, width: int):
    def run(key, members: pa.Table, known: pa.Table) -> pa.Table:
        none = pa.table({"list": pa.array([], pa.int64()), "a": pa.array([], pa.int64()), "b": pa.array([], pa.int64()), "more": pa.array([], pa.bool_())})
        if not len(members):
            return none
        order, sids, sizes, bits = _members(members)
        own = members["key"][0].as_py()
        sides, names = np.asarray(members["side"])[order].tolist(), members["keys"].to_pylist()
        smaller = [frozenset(k for k in names[i] if k < own) for i in order]

        def mine(i: int, j: int) -> bool:
            return (not sides[i] or sides[i] != sides[j]) and smaller[i].isdisjoint(smaller[j])

        ok = known["ok"].to_pylist()
        edges = list(zip(known["a"].to_pylist(), known["b"].to_pylist()))
        linked, refuted = ([e for e, k in zip(edges, ok) if k is want] for want in (True, False))
        found, more = proposals(sids, sizes, bits, threshold, linked, refuted, width, np.asarray(members["label"])[order], mine=mine)
        if not found:
            return none
        return pa.table({"list": pa.array([key[0].as_py()] * len(found), pa.int64()), "a": pa.array([a for a, _ in found], pa.int64()), "b": pa.array([b for _, b in found], pa.int64()), "more": pa.array([more] * len(found), pa.bool_())})

    return run


def _verify(threshold: Fraction):
    up, down = threshold.numerator, threshold.denominator

    def run(batches):
        for batch in batches:
            ok = []
            x, y = batch.column("x"), batch.column("y")
            for i in range(len(batch)):
                s, t = np.asarray(x[i].values), np.asarray(y[i].values)
                shared = len(np.intersect1d(s, t, assume_unique=True))
                ok.append(shared * down >= (len(s) + len(t) - shared) * up)
            yield kernel.rows(a=batch.column("a"), b=batch.column("b"), ok=pa.array(ok, pa.bool_()))

    return run


def _lists(posted: DataFrame) -> DataFrame:
    """(list, key, sid, side): the distinct candidate lists of two members and more, key being the
    smallest of their signatures. Long ones come in blocks of which every two meet; there, pairs of
    one block belong to the block's list with itself (side 0), others to members of different sides."""
    counts = posted.groupBy("sig").agg(F.count("*").alias("k")).where("k > 1")
    posted = posted.join(counts, "sig")
    blocks = F.ceil(F.col("k") / BLOCK).cast("int")
    own = F.pmod(F.xxhash64("sid"), F.col("blocks")).cast("int")
    meets = F.when(F.col("blocks") == 1, F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), F.col("blocks") - 1))
    spread = posted.withColumn("blocks", blocks).withColumn("own", own).withColumn("other", F.explode(meets))
    side = F.when(F.col("own") == F.col("other"), 0).when(F.col("own") < F.col("other"), 1).otherwise(2).alias("side")
    spread = spread.groupBy("sig", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"))
    grouped = spread.agg(F.sort_array(F.collect_set(F.struct("sid", side))).alias("sids")).where(F.size("sids") > 1)
    distinct = grouped.groupBy(F.xxhash64("sids").alias("list")).agg(F.min("sig").alias("key"), F.first("sids").alias("sids"))
    return distinct.select("list", "key", F.explode("sids").alias("member")).select("list", "key", "member.sid", "member.side")


def similar_classes(docs: DataFrame, words: int, threshold: Fraction) -> tuple[DataFrame, DataFrame]:
    """(facts, links): each row of ``docs`` (id, text and others) with n for text, its set's size,
    and sid, its set's name (null without words); and verified pairs of sids (a, b) that connect
    all that similarity connects."""
    spark = ship(docs.sparkSession)
    threshold = Fraction(threshold).limit_denominator(10_000)
    if not Fraction(7, 10) <= threshold <= 1:
        raise ValueError("thresholds from 0.7 to 1")
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema if f.name != "text")
    facts = cut(docs.mapInArrow(_facts(words), f"{kinds}, n long, sid long"))
    bits, lowest = frequencies(docs, words)
    with bitfilter.shared(spark, bits) as shared:
        posted = docs.select("text").mapInArrow(_signed(words, threshold, lowest, shared), "sig long, sid long").distinct()
        lists = _lists(posted)
        if "key" not in lists.columns:  # no signatures given: a list stands for itself
            lists = lists.withColumns({"key": F.col("list"), "side": F.lit(0)})
        lists = cut(lists)
    # one text for each candidate set
    chosen = facts.join(lists.select("sid").distinct(), "sid").groupBy("sid").agg(F.min_by(F.struct("id"), F.col("id")).alias("row"))
    chosen = chosen.select("sid", "row.id")
    described = docs.join(chosen, docs["id"].eqNullSafe(chosen["id"])).select("sid", "text").mapInArrow(_own_set(words), "sid long, n int, bits binary, tokens array<long>")
    described = cut(described.dropDuplicates(["sid"]))
    lengths = lists.groupBy("list").agg(F.count("*").alias("k"))
    longest = lists.join(lengths, "list").groupBy("sid").agg(F.max(F.struct("k", "list"))["list"].alias("longest"))
    members = lists.join(described.select("sid", "n", "bits"), "sid").join(longest, "sid")
    owned = cut(members.withColumn("own", F.col("list") == F.col("longest")).drop("longest"))
    asked = owned.join(owned.where("own").select("list").distinct(), "list", "left_semi").select("list", "sid", "n", "bits", "own")
    tokens = described.select("sid", "tokens")

    def checked(pairs: DataFrame) -> DataFrame:
        both = pairs.join(tokens.select(F.col("sid").alias("a"), F.col("tokens").alias("x")), "a").join(tokens.select(F.col("sid").alias("b"), F.col("tokens").alias("y")), "b")
        return both.mapInArrow(_verify(threshold), "a long, b long, ok boolean")

    verified = cut(checked(asked.groupBy("list").applyInArrow(_first(threshold), "a long, b long").distinct()))
    # what is connected by now is one part in all lists
    parts = components(verified.where("ok").select("a", "b")).select(F.col("node").alias("sid"), F.col("root").alias("label"))
    labelled = owned.drop("own").join(parts, "sid", "left").withColumn("label", F.coalesce("label", "sid"))
    several = labelled.groupBy("list").agg(F.min("label").alias("x"), F.max("label").alias("y")).where("x < y").select("list")
    keys = lists.groupBy("sid").agg(F.collect_set("key").alias("keys"))
    members = cut(labelled.join(several, "list", "left_semi").join(keys, "sid"))
    forget(lists, owned)
    known = spark.createDataFrame([], "list long, a long, b long, ok boolean")
    todo, width = members, 1
    while True:
        proposed = todo.groupBy("list").cogroup(known.groupBy("list")).applyInArrow(_propose(threshold, width), "list long, a long, b long, more boolean")
        proposed = cut(proposed)
        if proposed.isEmpty():
            break
        fresh = proposed.select("a", "b").distinct().join(verified, ["a", "b"], "left_anti")
        before, verified = verified, cut(checked(fresh).unionByName(verified))
        answered = proposed.join(verified, ["a", "b"]).select("list", "a", "b", "ok", "more")
        all_known = cut(known.unionByName(answered.drop("more")))
        again = answered.where("more OR NOT ok").select("list").distinct()  # only these may have more to say
        open_ = cut(members.join(again, "list", "left_semi")), cut(all_known.join(again, "list", "left_semi"))
        forget(proposed, before, all_known, *([todo, known] if width > 1 else []))
        todo, known = open_
        width *= 8
    forget(members, proposed, described, *([todo, known] if width > 1 else []))
    return facts, verified.where("ok").select("a", "b")


def _own_set(words: int):
    """As ``_described``, for the rows whose text has the wanted set (ids may repeat)."""
    describe = _described(words)

    def run(batches):
        for out in describe(batches):
            names = [set_id(np.asarray(t.values).view(U64)) if len(t.values) else None for t in out.column("tokens")]
            yield out.filter(pa.array([a == b for a, b in zip(names, out.column("sid").to_pylist())], pa.bool_()))

    return run


def join(docs: DataFrame, keep_id: str = "doc_id", text: str = "text", words: int = 3, threshold=Fraction(9, 10)) -> DataFrame:
    """One row per document: its id, n_shingles, component_id and set_id.

    A set is the distinct runs of ``words`` lower-cased words (A-Z), the whole sequence if there are
    fewer; component_id is the smallest id reachable by links of at least ``threshold``, itself
    included. Null, empty and blank texts have no set, are linked with nothing and are their own
    component (set_id null). Rows alike in text are linked, rows alike in id too are one by one in
    the result. A null id is never the smallest unless the component has no other. Tokens and sets
    are told apart by 64-bit hashes. An empty table gives no rows."""
    classed = _classed(docs.select(F.col(keep_id).alias("id"), F.col(text).alias("text")), words, threshold)
    return classed.select(F.col("id").alias(keep_id), F.col("n").alias("n_shingles"), "component_id", F.col("sid").alias("set_id"))


def _classed(docs: DataFrame, words: int, threshold: Fraction) -> DataFrame:
    """The facts of ``similar_classes`` with component_id."""
    facts, links = similar_classes(docs, words, threshold)
    roots = components(links).select(F.col("node").alias("sid"), F.col("root"))
    classed = facts.join(roots, "sid", "left").withColumn("root", F.coalesce("root", "sid"))
    smallest = classed.where("root IS NOT NULL").groupBy("root").agg(F.min("id").alias("smallest"))
    component = F.when(F.col("sid").isNull(), F.col("id")).otherwise(F.col("smallest"))
    return classed.join(smallest, "root", "left").withColumn("component_id", component).drop("root", "smallest")


def one_of_each(docs: DataFrame, id_column: str = "doc_id", text: str = "text", words: int = 5, threshold=Fraction(8, 10)) -> DataFrame:
    """``docs`` with one row left of each component, the one with the smallest id.

    Rows without words all stay. Of rows alike in id and text one stays; rows that share the
    smallest id but not the text stay, and so do different texts in a component without any id."""
    rid = F.xxhash64(F.col(id_column), F.col(text))
    with temporary_cuts(docs.sparkSession) as keep:
        classed = keep(cut(_classed(docs.select(F.col(id_column).alias("id"), F.col(text).alias("text"), rid.alias("rid")), words, threshold)))
    grouped = classed.where("sid IS NOT NULL")
    gone = grouped.where(~F.col("id").eqNullSafe(F.col("component_id"))).select("rid").distinct()
    kept = docs.withColumn("_rid", rid).join(gone.withColumnRenamed("rid", "_rid"), "_rid", "left_anti")
    twice = grouped.groupBy("rid").agg(F.count("*").alias("k")).where("k > 1").select(F.col("rid").alias("_rid"))
    if not twice.isEmpty():
        kept = kept.join(twice, "_rid", "left_anti").unionByName(kept.join(twice, "_rid", "left_semi").dropDuplicates(["_rid"]))
    return kept.select(*docs.columns)


NAME = "op2_token_combination_join"
SQL = None


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return join(table(spark, sf_dir, "documents")).drop("set_id")


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return one_of_each(docs)
