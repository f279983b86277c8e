"""E5: how large the sources are and how many of their ids the master resolves."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

from ..operators.metrics import distinct_ids, id_coverage, volumetry


def profile_sources(
    frames: Mapping[str, DataFrame],
    tickets: str,
    master: DataFrame,
    column: str = "username_ufinal",
    master_id: str = "cedula",
) -> dict[str, DataFrame]:
    """Volumetry of all sources and the coverage of one of them by the master."""
    ids = distinct_ids(frames[tickets], column)
    return {
        "volumetry": volumetry(frames, column),
        "coverage": id_coverage(ids, distinct_ids(master, master_id)),
    }
