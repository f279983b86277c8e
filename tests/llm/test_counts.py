"""Token rollups, language-model scores and archives."""

import gzip
import math
import re
import zlib
from collections import Counter

import pyarrow.fs as pafs
import pytest
from pyspark.sql import functions as F

from casemill.llm import bloom_lm, token_rollup, warc
from casemill.llm.tables import scratch_path

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
CHANGE = "op string, doc_id long, source string, lang string, text string"


def totals(rollup):
    return {(r.source, r.lang): (r.documents, r.tokens, r.bytes) for r in rollup.totals().where("tokenizer = 'words-1'").collect()}


def test_rollup_follows_signed_changes(spark):
    rollup = token_rollup.Rollup(spark, scratch_path(spark, "rollup"))
    send = lambda name, *rows: rollup.apply(name, spark.createDataFrame(list(rows), CHANGE))
    assert totals(rollup) == {}
    first = [("insert", 1, "s", "en", "a b c"), ("insert", 2, "s", None, None), ("insert", 3, "t", "de", "x"), ("insert", None, "s", "en", "lost"), ("other", 9, "s", "en", "no")]
    assert send("one", *first) and not send("one", *first)
    assert totals(rollup) == {("s", "en"): (1, 3, 5), ("s", None): (1, 0, 0), ("t", "de"): (1, 1, 1)}
    # revised, moved to another source, deleted, unknown deleted, inserted again
    send("two", ("revise", 1, "t", "de", "a b"), ("delete", 3, None, None, None), ("delete", 8, None, None, None), ("insert", 2, "s", "en", "z z z"))
    assert totals(rollup) == {("t", "de"): (1, 2, 3), ("s", "en"): (1, 3, 5)}
    rollup.compact()
    assert totals(rollup) == {("t", "de"): (1, 2, 3), ("s", "en"): (1, 3, 5)}
    assert not send("two", ("delete", 1, None, None, None))
    send("three", ("delete", 1, None, None, None), ("insert", 1, "t", "de", "late"), ("insert", 4, "u", "fr", "m n"), ("insert", 4, "u", "fr", "k l o"))
    assert totals(rollup)[("s", "en")] == (1, 3, 5) and ("t", "de") not in totals(rollup) and totals(rollup)[("u", "fr")][0] == 1
    assert send("empty") and not send("empty")


def test_a_batch_that_failed_counts_nothing(spark, monkeypatch):
    rollup = token_rollup.Rollup(spark, scratch_path(spark, "rollup"))
    change = spark.createDataFrame([("insert", 1, "s", "en", "a b")], CHANGE)
    with monkeypatch.context() as m:
        m.setattr(token_rollup.Rollup, "_commit", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            rollup.apply("one", change)
    assert totals(rollup) == {}
    assert rollup.apply("one", change) and totals(rollup) == {("s", "en"): (1, 2, 3)}


def test_vocabulary_version_counts_ids(spark):
    path = "/opt/tokenizers/byte_bpe_50k.tiktoken"
    versions = {"pieces": token_rollup.piece_tokens(path)}
    rollup = token_rollup.Rollup(spark, scratch_path(spark, "rollup"), versions)
    texts = ["hello world", "", "naïve 12345 text"]
    rollup.apply("one", spark.createDataFrame([("insert", i, "s", "en", t) for i, t in enumerate(texts)], CHANGE))
    import base64

    import public_tokenizers
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    own = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    assert rollup.totals().first().tokens == sum(len(own.encode_ordinary(t)) for t in texts)


def test_language_model_base_is_exact(docs, prose, monkeypatch):
    monkeypatch.setattr(bloom_lm, "FREQUENT", 5)  # most words take the join
    texts = [(i, prose(i % 7, 30, "abc") + " The THE the") for i in range(40)] + [(50, None), (51, ""), (None, "lost words"), (3, "again 3")]
    train = [t for t in texts if t[0] is None or zlib.crc32(str(t[0]).encode()) % 10]
    words = lambda t: WORDS.findall((t or "").translate({i: i + 32 for i in range(65, 91)})) + [None]
    counts = Counter(w for _, t in train for w in words(t))
    total, distinct = sum(counts.values()), len(counts)
    table = docs(*texts)
    learned = bloom_lm.learn(docs(*train))
    got = bloom_lm.score(table, learned, {"doc_id": F.col("doc_id"), "t": F.col("text")}).collect()
    assert len(got) == len(texts)
    for r in got:
        own = words(r.t)
        base = sum(math.log10((counts[w] + 0.1) / (total + 0.1 * (distinct + 1))) for w in own)
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(own), sum(counts[w] > 0 for w in own), total)
        assert abs(r.base_score - base) < 1e-9 * max(1, abs(base)) and r.score < 0
    empty = bloom_lm.score(table, bloom_lm.learn(table.limit(0)), {"doc_id": F.col("doc_id")}).collect()
    assert all(r.train_tokens == 0 and r.n_known == 0 and r.base_score == 0 for r in empty)


def test_language_model_prefers_seen_sequences(docs, prose):
    lines = [prose(k, 12, "abcdef") for k in range(5)]
    model, _ = learned = bloom_lm.learn(docs(*[" ".join(lines[(i + k) % 5] for k in range(3)) for i in range(60)]))
    seen, shuffled = lines[0], " ".join(sorted(lines[0].split()))
    rows = {r.doc_id: r for r in bloom_lm.score(docs(seen, shuffled), learned, {"doc_id": F.col("doc_id")}).collect()}
    assert rows[0].score > rows[1].score and abs(rows[0].base_score - rows[1].base_score) < 1e-9
    assert max(model.weights) > 0.3


def test_weights_are_fitted_on_all_training_texts(spark, docs, prose):
    lines = spark.createDataFrame([(prose(700 + k, 5),) for k in range(20)], "text string").orderBy(F.xxhash64("text"))
    first, *others = [r.text for r in lines.collect()]
    # the copies come first in the order of the hash; words seen 8 times are of level 4
    model, _ = bloom_lm.learn(docs(*[first] * 2100, *others * 8))
    assert model.weights[12] > 0.5 and model.weights[4] > 0.5


def test_lowest_levels_rise_to_fit():
    import numpy as np

    kinds = np.zeros((2, bloom_lm.LEVELS))
    kinds[0, 1], kinds[1, 2], kinds[1, 3] = 1e7, 1e9, 1e6
    assert bloom_lm.lowest_levels(kinds) == [1, 3]


def archive(pages, spark):
    return warc.write_warc(spark.createDataFrame(pages, "page_id long, url string, html string"), scratch_path(spark, "warc"))


PAGES = [(i, f"http://x/{i} y", "<p>" + str(i) * (i * 7 % 300)) for i in range(60)]
PAGES += [(100, "u", "same"), (101, None, "same"), (99, "v", "same"), (102, "w", None), (103, "w", ""), (None, "n", "same"), (104, "big", "z" * 300_000)]


@pytest.mark.parametrize("split", [97, 1000, 1 << 20])
def test_archives_read_back_in_any_split(spark, split):
    if split == 97:
        pages = PAGES[:30] + PAGES[60:66]
    else:
        pages = PAGES
    manifest = archive(pages, spark)
    records = {(r.page_id, r.url): r for r in warc.drop_nested(warc.read_warc(manifest, split)).collect()}
    assert len(records) == len(pages)
    for page, url, html in pages:
        r = records[page, None if url is None else url.replace(" ", "%20")]
        raw = (html or "").encode()
        first = {"same": 99}.get(html, min((p for p, _, h in pages if (h or "") == (html or "") and p is not None), default=None))
        assert (r.record_type, r.refers_to) == (("response", None) if page == first else ("revisit", first))
        assert r.digest == warc.digest(raw) and r.payload_length == len(raw)
        assert r.payload == (raw if r.record_type == "response" else None)


def test_archives_are_plain_gzip(spark):
    for row in archive(PAGES[:3], spark).collect():
        fs, path = pafs.FileSystem.from_uri(row.path)
        data = gzip.decompress(fs.open_input_file(path).readall())
        assert data.count(b"WARC/1.1\r\n") == row.records


def test_members_inside_payloads_and_noise_are_not_records(spark):
    inner = warc._member(warc.record(1, "in", b"inner", warc.digest(b"inner"), None))
    outer = b"WARC/1.1\r\nWARC-Type: resource\r\nX-Page-Id: 5\r\nContent-Length: %d\r\n\r\n" % (3 * len(inner) + 900)
    block = b"".join(inner + bytes(300) for _ in range(3))
    packer = zlib.compressobj(0, zlib.DEFLATED, 31)  # stored, so the inner members stand there as they are
    data = packer.compress(outer + block + b"\r\n\r\n") + packer.flush() + warc.MAGIC + b"noise" + inner
    name = scratch_path(spark, "nested").replace("file://", "") + ".warc.gz"
    fs, path = pafs.FileSystem.from_uri(name)
    fs.create_dir(path.rpartition("/")[0], recursive=True)
    with fs.open_output_stream(path, compression=None) as out:
        out.write(data)
    manifest = spark.createDataFrame([(name, len(data), 2)], warc.MANIFEST)
    for split in (64, 500, 1 << 20):
        got = warc.drop_nested(warc.read_warc(manifest, split)).collect()
        assert sorted(r.page_id for r in got) == [1, 5]
        assert next(r for r in got if r.page_id == 5).payload == block


def test_small_payloads_and_empty_tables(spark):
    pages = spark.createDataFrame([(1, "a", "xy"), (2, "a", "xy"), (3, "a", "long enough"), (4, "a", "long enough")], "page_id long, url string, html string")
    got = warc.read_warc(warc.write_warc(pages, scratch_path(spark, "w"), min_bytes=5)).collect()
    assert {r.page_id: r.record_type for r in got} == {1: "response", 2: "response", 3: "response", 4: "revisit"}
    assert warc.read_warc(warc.write_warc(pages.limit(0), scratch_path(spark, "w"))).count() == 0


def test_a_batch_may_have_any_name(spark):
    rollup = token_rollup.Rollup(spark, scratch_path(spark, "rollup"))
    row = lambda i: spark.createDataFrame([("insert", i, "s", "en", "a b")], CHANGE)
    assert rollup.apply("b1", row(1)) and rollup.apply("compacted:x", row(2)) and rollup.apply("compacted", row(3))
    assert totals(rollup) == {("s", "en"): (3, 6, 9)}
    rollup.compact()
    assert not rollup.apply("compacted", row(4)) and rollup.apply("b2", row(4))
    assert totals(rollup) == {("s", "en"): (4, 8, 12)}


@pytest.mark.parametrize("capacity", [None, 150])
def test_language_model_counts_every_ngram(docs, prose, monkeypatch, capacity):
    """Also pairs seen once and, with a small filter, all levels that have no room in it."""
    if capacity:
        monkeypatch.setattr(bloom_lm, "CAPACITY", capacity)
    texts = [(i, prose(i % 9, 25, "abc") + f" only{i} once{i}") for i in range(30)] + [(40, None), (41, prose(3, 25, "abc") + " only3 once3")]
    train = texts[:26]
    learned = model, _ = bloom_lm.learn(docs(*train))
    assert (model.lowest[0] > 1 and model.lowest[1] > 2) == bool(capacity)
    got = {r.doc_id: r for r in bloom_lm.score(docs(*texts), learned, {"doc_id": F.col("doc_id")}).collect()}
    words = lambda t: [*(t or "").split(), "</s>"]
    ones, twos = Counter(), Counter()
    for _, t in train:
        own = words(t)
        ones.update(["<s>", *own])
        twos.update(zip(["<s>", *own], own))
    total = sum(n for w, n in ones.items() if w != "<s>")

    def mean(counts, key):
        same = [n for n in counts.values() if n.bit_length() == counts[key].bit_length()]
        return sum(same) / len(same) if counts[key] else 0

    def one(before, word):
        context, pair = mean(ones, before), mean(twos, (before, word))
        w = model.weights[ones[before].bit_length()]
        return math.log10(w * min(1, pair / max(context, 1)) + (1 - w) * (mean(ones, word) + 0.1) / (total + 0.1 * len(ones)))

    assert len(got) == len(texts)
    for i, t in texts:
        own = words(t)
        assert got[i].score == pytest.approx(sum(map(one, ["<s>", *own], own)), rel=1e-9)
