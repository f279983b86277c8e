"""The registered query of each operator and, where SQL can say the same, its SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import (
    bloom_lm, bounded_ring, decontaminate, jaccard_join, language_mixture, lexical_search, merkle_manifest, quality_fm, segment_search,
    sentencepiece_wfst, suffix_dedup, token_rollup, warc,
)

MODULES = (
    token_rollup, jaccard_join, segment_search, warc, quality_fm, bloom_lm, decontaminate, language_mixture, sentencepiece_wfst, suffix_dedup,
    merkle_manifest, bounded_ring, lexical_search,
)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {m.NAME: m.query for m in MODULES}


def oracle_sql() -> dict[str, str]:
    return {m.NAME: m.SQL for m in MODULES if m.SQL is not None}
