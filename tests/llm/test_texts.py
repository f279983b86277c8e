"""Passage removal, decontamination, language, quality and encoding on small tables."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
import sentencepiece
from pyspark.sql import functions as F

from casemill.llm import decontaminate, language_mixture, quality_fm, sentencepiece_wfst, suffix_dedup


def brute_removed(texts, length):
    raw = [(t or "").encode() for t in texts]
    seen = Counter(r[i : i + length] for r in raw for i in range(len(r) - length + 1))
    out = []
    for r in raw:
        gone = [False] * len(r)
        for i in range(len(r) - length + 1):
            if seen[r[i : i + length]] > 1:
                gone[i : i + length] = [True] * length
        kept = bytes(b for b, g in zip(r, gone) if not g)
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out.append((len(r), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("group", [2048, 2])
def test_removal_is_exact(docs, prose, monkeypatch, group):
    monkeypatch.setattr(suffix_dedup, "GROUP", group)  # 2: longer grams split crowded ones
    monkeypatch.setattr(suffix_dedup, "SEGMENT", 1 << 10)  # long texts come in pieces
    rng = random.Random(4)
    line, page = prose(1, 12), prose(2, 80)
    texts = [prose(k, rng.randint(5, 40)) + line[: rng.randint(10, len(line))] + prose(k + 50, 20) for k in range(10, 40)]
    texts += [prose(90, 8) + page[rng.randint(0, 60) : rng.randint(250, 400)] + prose(91 + k, 30) for k in range(8)]
    texts += [page, page, "ab" * 150, "x" * 300, "é" * 90 + line, None, "", "short", prose(200, 600) + page + prose(201, 500)]
    got = {r.doc_id: tuple(r)[1:] for r in suffix_dedup.remove(docs(*texts), {"doc_id": F.col("doc_id")}, length=60).drop("kept", "kept_text").collect()}
    assert [got[i] for i in range(len(texts))] == brute_removed(texts, 60)


def test_removal_of_odd_rows(docs):
    rows = docs((1, "q" * 250), (1, "q" * 250), (None, None), (2, "r" * 199), (3, "r" * 200))
    got = sorted((str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans) for r in suffix_dedup.remove(rows, {"doc_id": F.col("doc_id")}).collect())
    assert got == [("1", 250, 250, 1), ("1", 250, 250, 1), ("2", 199, 0, 0), ("3", 200, 0, 0), ("None", 0, 0, 0)]
    assert suffix_dedup.remove(docs().limit(0), {"doc_id": F.col("doc_id")}).count() == 0


def test_a_repeated_passage_is_one_span_of_each_text(docs, prose):
    page = prose(6, 100)
    texts = docs(*[prose(300 + k, 10) + page + prose(400 + k, 10) for k in range(12)])
    found = suffix_dedup.spans(texts.select(F.xxhash64("doc_id", "text").alias("rid"), "text"), 60).collect()
    assert len({r.rid for r in found}) == 12 and len(found) <= 4 * 12  # not one for each of its contexts


def test_short_texts_have_no_windows_even_if_many_stand_together():
    data = np.frombuffer(b"a" * 300, np.uint8)
    assert not any(len(x) for x in suffix_dedup.anchors(data, np.array([0, 150, 150, 300]), 200, 64))


def test_direct_sorting_takes_one_key_a_round(monkeypatch):
    rng = np.random.default_rng(3)
    text = np.tile(rng.integers(0, 3, 500).astype(np.uint8), 3)
    monkeypatch.setattr(np, "lexsort", None)  # two keys cost twice the time
    order = suffix_dedup.suffix_array(text, 40)
    raw = text.tobytes()
    found = [raw[i : i + 40].ljust(40, b"\0") for i in order]
    assert sorted(order.tolist()) == list(range(len(text))) and found == sorted(found)


def test_kept_text_has_whole_characters(docs, prose):
    page = prose(5, 60)
    kept = suffix_dedup.stage(None, docs("é" + page + "ü rest", "à" + page + "ö other", None), "")
    rows = {r.doc_id: r for r in kept.collect()}
    assert rows[2].text is None and all(page not in rows[i].text and rows[i].n_chars == len(rows[i].text) for i in (0, 1))
    assert "rest" in rows[0].text and "other" in rows[1].text


def edit_distance_within(pattern, text):
    row = [0] * (len(text) + 1)
    for i, p in enumerate(pattern, 1):
        row, old = [i], row
        for j, c in enumerate(text, 1):
            row.append(min(old[j] + 1, row[j - 1] + 1, old[j - 1] + (p != c)))
    return min(row)


def test_myers_distance_is_exact():
    rng = random.Random(8)
    for _ in range(150):
        pattern = "".join(rng.choice("abc") for _ in range(rng.randint(1, 90)))
        text = "".join(rng.choice("abcd") for _ in range(rng.randint(0, 120)))
        if rng.random() < 0.5:
            text = text[:20] + pattern[: rng.randint(0, 90)] + text[20:]
        distance, start, end = decontaminate.match(pattern, text)
        assert distance == edit_distance_within(pattern, text)
        assert edit_distance_within(pattern, text[start:end]) == distance


def test_leaks_within_the_budget_are_found(spark, docs, prose):
    item = prose(1, 20)
    rng = random.Random(2)

    def edited(k):
        out = list(item)
        for _ in range(k):
            out[rng.randrange(len(out))] = "#"
        return "".join(out)

    budget = int(0.05 * len(item))
    texts = [prose(10, 30) + " " + t + " " + prose(11, 30) for t in (item, item.upper(), item.replace(" ", "\n "), edited(budget), prose(12, 20))]
    texts += [None, "", item[: len(item) // 2], texts[0]]
    benchmark = spark.createDataFrame([(1, item), (2, None), (3, "tiny"), (4, item), (None, prose(70, 20))], "item_id long, text string")
    found = decontaminate.find(docs(*texts), benchmark, {"doc_id": F.col("doc_id")}).collect()
    assert {(r.doc_id, r.item_id) for r in found} == {(d, i) for d in (0, 1, 2, 3, 8) for i in (1, 4)}
    assert all(r.distance <= budget for r in found) and {r.distance for r in found if r.doc_id in (0, 1, 2, 8)} == {0}
    clean = decontaminate.without_leaks(docs(*texts), benchmark)
    assert sorted(r.doc_id for r in clean.collect()) == [4, 5, 6, 7]
    assert decontaminate.find(docs(*texts), benchmark.limit(0), {"doc_id": F.col("doc_id")}).count() == 0


def test_no_two_blocks_share_a_name():
    class Shared:  # stands for a broadcast that is freed before the next one is made
        def __init__(self, items):
            self.value = items

    names = set()
    for k in range(50):
        block = decontaminate._Block(Shared([(k, f"item {k} " * 5, 0)]))
        items, found = decontaminate._ready(block)
        assert [i for i, *_ in decontaminate.matches(items[0][1], items, found)] == [0]
        names.add(block.id)
        del block, items, found
    assert len(names) == 50


def test_blocks_and_benchmarks_of_one_session_stay_apart(spark, docs, prose, monkeypatch):
    monkeypatch.setattr(decontaminate, "BLOCK_CHARS", 300)  # about two items a block
    items = [(i, prose(500 + i, 25)) for i in range(12)]
    table = docs(*[prose(40 + i, 10) + " " + t + " " + prose(60 + i, 10) for i, t in items], prose(99, 30))
    for mine in (items[:6], items[6:], items):
        benchmark = spark.createDataFrame(mine, "item_id long, text string")
        assert len(list(decontaminate.blocks(benchmark, 0.05))) > 1
        found = decontaminate.find(table, benchmark, {"doc_id": F.col("doc_id")}).collect()
        assert sorted((r.doc_id, r.item_id, r.distance) for r in found) == [(i, i, 0) for i, _ in mine]
        clean = decontaminate.without_leaks(table, benchmark).collect()
        assert sorted(r.doc_id for r in clean) == sorted({*range(13)} - {i for i, _ in mine})


def test_every_edited_passage_is_found_by_brute_force(docs, spark, prose):
    rng = random.Random(6)
    items = [(i, prose(300 + i, 8)) for i in range(6)]
    texts = []
    for k in range(40):
        _, t = rng.choice(items)
        out = list(t)
        for _ in range(rng.randint(0, 5)):
            at = rng.randrange(len(out))
            out[at : at + rng.choice([0, 1])] = rng.choice(["", "z", "yy"])
        texts.append(prose(k, 5) + " " + "".join(out) + " " + prose(k + 60, 5))
    got = {(r.doc_id, r.item_id): r.distance for r in decontaminate.find(docs(*texts), spark.createDataFrame(items, "item_id long, text string"), {"doc_id": F.col("doc_id")}).collect()}
    want = {}
    for d, t in enumerate(texts):
        for i, item in items:
            distance = edit_distance_within(decontaminate.normal(item), decontaminate.normal(t))
            if distance <= int(0.05 * len(decontaminate.normal(item))):
                want[d, i] = distance
    assert got == want and want


def test_mixtures_find_both_languages(spark, prose):
    one, two = "abcdefgh", "mnopqrst"
    rows = [(i, prose(i, 60, one if i % 2 else two), "xx" if i % 2 else "yy") for i in range(40)]
    model = language_mixture.learn(spark.createDataFrame(rows + [(99, "abc", None)], "doc_id long, text string, lang string"))
    assert model[0] == ["xx", "yy"]
    texts = [prose(100, 50, one), prose(101, 50, two), prose(102, 60, one) + " " + prose(103, 30, two), "12 34 !!", "", None, "é", prose(100, 50, one)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r for r in language_mixture.identify(df, model, {"doc_id": F.col("doc_id")}).collect()}
    assert [got[i].lang_pred for i in range(6)] == ["xx", "yy", "xx", "und", "und", "und"]
    assert [m.lang for m in got[2].mixture] == ["xx", "yy"] and 0.55 < got[2].score < 0.8
    assert len(got[0].mixture) == 1 and got[0].score == 1.0 and got[3].score == 0.0
    assert got[6].lang_pred in ("xx", "yy") and got[7].lang_pred == "xx"
    none = language_mixture.learn(spark.createDataFrame([], "doc_id long, text string, lang string"))
    assert {r.lang_pred for r in language_mixture.identify(df, none, {"doc_id": F.col("doc_id")}).collect()} == {"und"}
    assert language_mixture.identify(df.limit(0), model, {"doc_id": F.col("doc_id")}).count() == 0


def test_quality_is_learned_and_held_out(spark):
    folder = "/root/testdata/sf0.01"
    got = quality_fm.query(spark, folder).toPandas().merge(spark.read.parquet(f"{folder}/labels.parquet").toPandas(), on="doc_id")
    held = got[got.held_out]
    good, bad = held[held.quality == 1], held[held.quality == 0]
    pairs = sum((g > b) + (g == b) / 2 for g in good.score for b in bad.score)
    assert pairs / (len(good) * len(bad)) > 0.95
    assert (held.predicted == held.quality).mean() > 0.9


def test_quality_of_odd_rows(spark, docs):
    table = docs("A fine text of words.", "", None, "x " * 5000, "#### $$$$").withColumn("score", F.lit("old"))
    model = quality_fm.learn(table, spark.createDataFrame([(None, 1), (0, None), (77, 1)], "doc_id long, quality int"))
    got = quality_fm.score(table, model)
    assert got.columns == ["doc_id", "text", "lang", "source", "n_chars", "score"]
    rows = got.collect()
    assert len(rows) == 5 and all(0 <= r.score <= 1 for r in rows)
    assert quality_fm.score(table.limit(0), model).count() == 0
    assert quality_fm.score(docs("a").drop("n_chars"), model).count() == 1


def test_factorisation_identity():
    import numpy as np

    rng = np.random.default_rng(2)
    feature, value = np.array([3, 9, 20]), np.array([0.5, 1.0, 2.0])
    linear, factors = rng.normal(size=quality_fm.SIZE), rng.normal(size=(quality_fm.SIZE, quality_fm.FACTORS))
    out, _ = quality_fm.margins(np.zeros(3, int), feature, value, 1, 0.25, linear, factors)
    pairs = sum(factors[feature[i]] @ factors[feature[j]] * value[i] * value[j] for i in range(3) for j in range(i))
    assert abs(out[0] - (0.25 + linear[feature] @ value + pairs)) < 1e-9


def test_pieces_equal_the_library(docs):
    library = sentencepiece.SentencePieceProcessor(model_file=sentencepiece_wfst.MODEL)
    rng = random.Random(3)
    parts = [" ", "   ", "the", "ing", "é", "\n", "\t", "😀", "\x00", "A", "23", "--", "中", "Ａ", "ﬁ", "tion", "xq"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 30))) for _ in range(300)] + [None, "", " " * 50, "w" * 3000]
    coded = sentencepiece_wfst.round_trip(docs(*texts).withColumn("ids", F.lit(1)))
    rows = {r.doc_id: r for r in coded.collect()}
    for i, t in enumerate(texts):
        assert list(rows[i].ids) == library.encode(t or "") and rows[i].round_trip
    assert sentencepiece_wfst.round_trip(docs().limit(0)).count() == 0


def test_decoding_of_null_ids(spark):
    df = spark.createDataFrame([(None,), ([],)], "ids array<int>")
    assert [r.decoded for r in sentencepiece_wfst.decode(df).collect()] == [None, ""]


def test_models_it_would_get_wrong_are_refused(tmp_path):
    """The given model with another model type or normaliser in its file."""
    raw = open(sentencepiece_wfst.MODEL, "rb").read()
    assert sentencepiece_wfst.check_model(sentencepiece_wfst.MODEL) is None
    trainer, normaliser = raw.index(b"\x06tok_v0\x18\x02") + 9, raw.rindex(b"\x18\x01 \x002")
    for name, at, byte in (("unigram", trainer - 1, 1), ("spaces", normaliser + 3, 1), ("prefix", normaliser + 1, 0)):
        changed = bytearray(raw)
        assert changed[at] != byte
        changed[at] = byte
        path = tmp_path / f"{name}.model"
        path.write_bytes(changed)
        with pytest.raises(ValueError, match="isn't supported"):
            sentencepiece_wfst.load(str(path))


def test_round_trip_keeps_what_is_asked_for(spark, docs):
    coded = sentencepiece_wfst.round_trip(docs("one two", None, "▁x " * 5, "é" * 90_000).withColumn("round_trip", F.lit("old")), keep=["doc_id"])
    assert coded.columns == ["doc_id", "ids", "round_trip"] and all(r.round_trip is True for r in coded.collect())


def test_solved_parts_are_kept_within_bounds_and_give_the_same_ids(prose, monkeypatch):
    from casemill.llm import sentencepiece_wfst as wfst

    texts = [prose(k, 40) for k in range(30)] + ["again and again"] * 3
    whole = wfst.Transducer(wfst.load())
    want = [whole.encode(t).tolist() for t in texts]
    monkeypatch.setattr(wfst, "PARTS", 25)
    small = wfst.Transducer(wfst.load())
    assert [small.encode(t).tolist() for t in texts] == want
    assert len(small.parts) <= 25 and 0 < len(small.older) <= 25


def test_a_part_met_again_after_many_others_is_not_solved_again():
    from casemill.llm import sentencepiece_wfst as wfst

    machine, solved = wfst.Transducer(wfst.load()), []
    search = machine.shortest_path
    machine.shortest_path = lambda part: solved.append(part) or search(part)
    words = [f"{chr(97 + k % 26)}{k}" for k in range(120_000)]
    machine.encode(" ".join(words))
    machine.encode(" ".join(words[:5_000]))
    assert len(solved) == len(words)
