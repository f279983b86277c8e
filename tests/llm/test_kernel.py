import re

import numpy as np
import pyarrow as pa

from casemill.llm import bitfilter, kernel

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
TEXTS = ["", None, "  \t\n", "One two  THREE", "é ÉÀ x\x0bY", "a" * 40, "ends ", " starts", "x y 日本 語"]


def test_words_are_those_of_the_pattern_and_stay_in_their_text():
    for lo, hi, data, offsets in kernel.chunks(pa.array(TEXTS), 16):
        starts, ends, first = kernel.word_spans(kernel.lower(data), offsets)
        raw = kernel.lower(data).tobytes()
        for r in range(hi - lo):
            got = [raw[a:b].decode() for a, b in zip(starts[first[r] : first[r + 1]], ends[first[r] : first[r + 1]])]
            text = (TEXTS[lo + r] or "").translate({i: i + 32 for i in range(65, 91)})
            assert got == WORDS.findall(text)


def test_hashes_depend_on_the_word_only():
    a, first_a = kernel.word_hashes(np.frombuffer(b"xx ab cd ab", np.uint8), np.array([0, 11]))
    b, _ = kernel.word_hashes(np.frombuffer(b"ab", np.uint8), np.array([0, 2]))
    assert a[1] == a[3] == b[0] and len(set(a.tolist())) == 3 and first_a.tolist() == [0, 4]
    c, _ = kernel.word_hashes(np.frombuffer(b"a ab aab aaab", np.uint8), np.array([0, 13]))
    assert len(set(c.tolist())) == 4


def test_shingles_of_short_texts():
    w = np.arange(1, 6, dtype=np.uint64)
    assert len(kernel.shingles(w[:0], 3)) == 0
    assert len(kernel.shingles(w[:2], 3)) == 1
    assert len(kernel.shingles(w, 3)) == 3
    assert len(kernel.shingles(np.repeat(w[:1], 9), 3)) == 1
    assert kernel.shingles(w[:2], 3)[0] != kernel.shingles(w[:2][::-1], 3)[0]


def test_slices_of_a_column_keep_their_texts():
    column = pa.array(["left", "right", None, "last"]).slice(1)
    assert [d.tobytes() for _, _, d, _ in kernel.chunks(column, 1)] == [b"right", b"", b"last"]


def test_filter_has_no_false_negatives(spark):
    keys = spark.range(5000).selectExpr("xxhash64(id) AS key", "1 AS low", "CAST(1 + id % 4 AS INT) AS high")
    found = bitfilter.build(keys, 22, 4)
    rows = keys.toPandas()
    values = rows["key"].to_numpy().view(np.uint64)
    for level in range(1, 5):
        has = bitfilter.contains(found, values, 22, 4, level)
        assert has[rows["high"] >= level].all()
        assert has[rows["high"] < level].mean() < 0.02 if (rows["high"] < level).any() else True


def test_a_filter_is_built_in_one_go_however_many_partitions(spark):
    partitions = spark.conf.get("spark.sql.shuffle.partitions")
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    context = spark.sparkContext
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # else each shuffle is a job of its own
    context.setJobGroup("one filter", "one filter")
    try:
        filter_ = bitfilter.build(spark.range(500).selectExpr("id * 7 AS key"), 16, 4)
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
        context.setLocalProperty("spark.job.description", None)
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    assert len(context.statusTracker().getJobIdsForGroup("one filter")) == 1
    assert bitfilter.contains(filter_, np.arange(500, dtype=np.int64).view(np.uint64) * np.uint64(7), 16, 4).all()
