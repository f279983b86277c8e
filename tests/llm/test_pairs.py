"""The Jaccard join, components and the top-k search against brute force."""

import math
import random
from collections import defaultdict
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest
from pyspark import Broadcast
from pyspark.sql import functions as F

from casemill import session
from casemill.llm import jaccard_join, segment_search, suffix_dedup
from casemill.llm.components import components


def brute_components(texts, words, threshold):
    sets = {}
    for i, t in texts:
        w = (t or "").lower().split()
        sets[i] = {tuple(w[k : k + words]) for k in range(max(1, len(w) - words + 1))} if w else set()
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b]:
                shared = len(sets[a] & sets[b])
                if shared >= threshold * (len(sets[a]) + len(sets[b]) - shared):
                    x, y = find(a), find(b)
                    root[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in ids}


def near_copies(seed, n, length, edits):
    rng = random.Random(seed)
    base = [f"w{rng.randrange(400)}" for _ in range(length)]
    out = []
    for _ in range(n):
        text = list(base)
        for _ in range(rng.randint(0, edits)):
            text[rng.randrange(length)] = f"e{rng.randrange(10**6)}"
        out.append(" ".join(text))
    return out


@pytest.mark.parametrize("words,threshold,frequent", [(3, Fraction(9, 10), 7), (5, Fraction(8, 10), 3), (3, Fraction(9, 10), 2)])
def test_join_is_exact(docs, monkeypatch, words, threshold, frequent):
    monkeypatch.setattr(jaccard_join, "FREQUENT", frequent)  # token pairs come into play early
    monkeypatch.setattr(jaccard_join, "BLOCK", 16)  # and lists are cut into blocks
    texts = near_copies(1, 60, 60, 5) + near_copies(2, 25, 150, 12) + near_copies(3, 12, 12, 2)
    texts += ["", None, "  ", "one", "One", "one two", "a b c", "the of " * 40, "the of " * 41, texts[0], texts[0]]
    rows = list(enumerate(texts))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.join(docs(*rows), words=words, threshold=threshold).collect()}
    assert got == brute_components(rows, words, threshold)


def test_no_partner_is_held_back_for_good(docs, monkeypatch):
    """x is tied to the groups A and B; its first pairs with both fail, and A alone fills its width."""
    rng = random.Random(8)

    def text(group, changed, low, high):
        # a set whose name, by which a list is ordered, lies between low and high
        while True:
            words = [f"{group}{i}" if i in changed else f"u{i}" for i in range(1000)] + [f"z{rng.random()}"]
            tokens = next(t for _, t in jaccard_join.sets_of(pa.array([" ".join(words)]), 1))
            if low <= jaccard_join.set_id(tokens) / 2**63 < high:
                return " ".join(words)

    a, b = range(40), range(100, 140)
    texts = [text("a", range(54), -1, -0.8)] + [text("a", a, -0.8, -0.3) for _ in range(9)]
    texts += [text("b", range(100, 154), -0.3, 0)] + [text("b", b, 0, 0.5) for _ in range(2)]
    texts += [text("x", (), 0.5, 1)]
    one_list = lambda posted: posted.select(F.lit(1).cast("long").alias("list"), "sid").distinct()
    monkeypatch.setattr(jaccard_join, "_lists", one_list)
    rows = list(enumerate(texts))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.join(docs(*rows), words=1).collect()}
    assert got == brute_components(rows, 1, Fraction(9, 10)) and {c for _, c in got.values()} == {0}


def test_a_pair_is_proposed_in_one_of_its_lists(docs, monkeypatch):
    written, cut = [], jaccard_join.cut

    def counted(df):
        out = cut(df)
        if {"a", "b"} <= set(out.columns):
            written.append(out.count())
        return out

    monkeypatch.setattr(jaccard_join, "cut", counted)
    texts = near_copies(4, 80, 150, 12) + near_copies(5, 80, 150, 30)
    rows = list(enumerate(texts))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.join(docs(*rows), words=5, threshold=Fraction(8, 10)).collect()}
    assert got == brute_components(rows, 5, Fraction(8, 10))
    assert max(written) <= 2 * len(texts)  # not once for each signature that both sets have


def test_join_handles_odd_rows(docs):
    odd = docs((7, "same text here"), (7, "same text here"), (None, "same text here"), (None, "alone"), (3, None))
    got = sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in jaccard_join.join(odd).collect())
    assert got == [("3", 0, "3"), ("7", 1, "7"), ("7", 1, "7"), ("None", 1, "7"), ("None", 1, "None")]
    assert jaccard_join.join(docs().limit(0)).count() == 0
    assert jaccard_join.one_of_each(odd).count() == 3


def test_one_of_each_keeps_the_rest(docs, prose):
    a = prose(1, 60)
    kept = jaccard_join.one_of_each(docs((5, a), (2, a), (9, a + " more"), (4, prose(2, 50)), (6, ""), (8, None), (1, "extra one")))
    assert sorted(r.doc_id for r in kept.collect()) == [1, 2, 4, 6, 8]
    assert kept.columns == ["doc_id", "text", "lang", "source", "n_chars"]


def test_low_thresholds_are_refused(docs):
    with pytest.raises(ValueError):
        jaccard_join.join(docs("a"), threshold=Fraction(1, 2))


def test_components_of_chains_and_stars(spark):
    rng = random.Random(3)
    edges = [(i, i + 1) for i in range(100, 160)] + [(500, i) for i in range(501, 560)] + [(7, 7), (8, 9), (9, 8), (9, 10)]
    rng.shuffle(edges)
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = {i: 100 for i in range(100, 161)} | {i: 500 for i in range(500, 560)} | {8: 8, 9: 8, 10: 8}
    assert got == want
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_bounds_never_exceed_distances():
    rng = np.random.default_rng(1)
    q, c = rng.integers(-30, 30, (20, 37)).astype(float), rng.integers(-30, 30, (50, 37)).astype(float)
    true = ((q[:, None] - c[None]) ** 2).sum(2)
    previous = None
    for segments in (1, 4, 16, 37):
        bound = segment_search.lower_bound(q, c, segments)
        assert (bound <= true + 1e-6).all()
        assert previous is None or (bound >= previous - 1e-6).mean() > 0.95  # finer is tighter, nearly always
        previous = bound


def test_top_k_with_odd_vectors(spark, monkeypatch):
    monkeypatch.setattr(segment_search, "BLOCK", 16)
    rng = random.Random(5)
    rows = [(i, [rng.choice([-1.0, 0.0, 0.25, 0.5, 1.0]) for _ in range(10)]) for i in range(70)]
    rows += [(100, None), (101, [float("nan")] * 10), (102, [1.0, None] + [0.0] * 8), (103, [float("inf")] * 10), (None, [1.0] * 10)]
    rows += [(120, [1.0, 2.0]), (121, [3.0, 1.0]), (140, []), (60, rows[60][1])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = defaultdict(list)
    for r in segment_search.top_k(df, "vec_id", "embedding", F.col("vec_id") % 20 == 0).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.vec_id, r.score))
    good = [(i, [int(np.floor(64 * x)) for x in v]) for i, v in rows if i is not None and i not in (100, 101, 102, 103)]
    want = {}
    for i, q in good:
        if i % 20 == 0:
            scored = sorted((-sum(a * b for a, b in zip(q, c)), j) for j, c in good if j != i and len(c) == len(q))
            want[i] = [(j, -s) for s, j in scored[:20]]
    assert dict(got) == {i: w for i, w in want.items() if w}
    assert segment_search.top_k(df.limit(0), "vec_id", "embedding", F.col("vec_id") % 20 == 0).count() == 0


def test_top_k_keeps_large_components(spark):
    """Components in the millions stand beside small ones; only what can't be scored exactly stops the search."""
    rng = random.Random(4)
    rows = [(i, [rng.choice([0.5, -3.25, 2.0**21, -(2.0**22), 2.0**23, 1e7 if i % 3 else 7.0]) * rng.choice([1, 1, -1]) for _ in range(6)]) for i in range(90)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {(r.query_id, r.rank): (r.vec_id, r.score) for r in segment_search.top_k(df, "vec_id", "embedding", F.col("vec_id") % 20 == 0, k=5).collect()}
    whole = {i: [math.floor(64 * x) for x in v] for i, v in rows}
    for q in range(0, 90, 20):
        best = sorted(((-sum(a * b for a, b in zip(whole[q], whole[i])), i) for i in whole if i != q))[:5]
        assert [got[q, r + 1] for r in range(5)] == [(i, -s) for s, i in best]
    far = spark.createDataFrame([(1, [1e300, 1.0]), (20, [1.0, 1.0])], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="too long"):
        segment_search.top_k(far, "vec_id", "embedding", F.col("vec_id") % 20 == 0).collect()


def test_one_of_each_leaves_a_single_cut_behind(spark, docs, prose, tmp_path, monkeypatch):
    monkeypatch.setattr(session, "shared_dir", lambda _: f"file://{tmp_path}")
    texts = [t for t in near_copies(5, 6, 60, 1)]
    kept = jaccard_join.one_of_each(docs(*texts, prose(1, 40), None, ""))
    left = [p for p in tmp_path.iterdir() if any(p.rglob("*.parquet"))]
    assert len(left) == 1, left  # the classes, which the result reads
    assert kept.count() >= 4


def test_components_leave_a_single_cut_behind(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(session, "shared_dir", lambda _: f"file://{tmp_path}")
    found = components(spark.createDataFrame([(i, i + 1) for i in range(20)], "a long, b long"))
    assert len([p for p in tmp_path.iterdir() if any(p.rglob("*.parquet"))]) == 1
    assert {r.root for r in found.collect()} == {0}


def test_filters_and_tables_go_when_nothing_asks_them(spark, docs, prose, tmp_path, monkeypatch):
    """A filter lies on the disks of the driver and of every executor, and not until the application ends."""
    monkeypatch.setattr(session, "shared_dir", lambda _: f"file://{tmp_path}")
    made, gone, context = [], [], spark.sparkContext
    broadcast, destroy = context.broadcast, Broadcast.destroy
    monkeypatch.setattr(context, "broadcast", lambda value: made.append(broadcast(value)) or made[-1])
    monkeypatch.setattr(Broadcast, "destroy", lambda self, *a, **b: gone.append(self) or destroy(self, *a, **b))
    passage = prose(1, 80)
    texts = docs(passage + prose(2, 60), prose(3, 60) + passage, "short", "", passage, passage)
    spans = suffix_dedup.spans(texts.select(F.xxhash64("doc_id", "text").alias("rid"), "text"))
    assert len(made) >= 3 and gone == made
    left = {f.as_uri().rpartition("/cut.parquet")[0] for f in tmp_path.rglob("*.parquet") if f.is_file()}
    read = {f.replace("file:///", "/").rpartition("/cut.parquet")[0] for f in spans.inputFiles()}
    assert {p.removeprefix("file://") for p in left} == read  # the spans alone
    assert spans.select("rid").distinct().count() == 4
    made.clear(), gone.clear()
    _, links = jaccard_join.similar_classes(texts.select(F.col("doc_id").alias("id"), "text"), 3, Fraction(9, 10))
    assert len(made) == 1 and gone == made
    assert links.count() == 0  # copies are one set, the others share too little
