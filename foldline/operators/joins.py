"""Joining a fitted statistics table back to the rows.

Statistics tables (per-category means, per-group medians, vocabularies) are
usually tiny but can grow with key cardinality. ``lookup_join`` measures the
table (it is materialised first, so the count and the join read the same
rows); whether it is broadcast is left to AQE, which knows its bytes, and a
shuffle join is split when a key is hot (``spark.sql.adaptive.skewJoin.enabled``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from foldline.session import cut_lineage


def measured(stats: DataFrame) -> tuple[DataFrame, int]:
    """Materialise a statistics table and count its rows (fit time)."""
    stats = cut_lineage(stats)
    return stats, stats.count()


def lookup_join(rows: DataFrame, stats: DataFrame, on: Sequence[str] | str, how: str = "left",
                n_rows: int | None = None) -> DataFrame:
    """``rows JOIN stats``; AQE broadcasts ``stats`` if its bytes are under the session's threshold.

    Pass ``n_rows`` when ``stats`` comes from :func:`measured`, else it is materialised first.
    """
    return rows.join(measured(stats)[0] if n_rows is None else stats, on=on, how=how)
