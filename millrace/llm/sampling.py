"""Bounded samples by digests, whose cost does not grow with the number of tasks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def draw_of(doc_id: str = "doc_id") -> Column:
    """md5 of an id's text as hex; a missing id counts as the empty text."""
    return F.md5(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary"))


def drawn_below(draw: Column, share: float | Column) -> Column:
    """Whether a digest lies in the first ``share`` of all digests."""
    return F.conv(F.substring(draw, 1, 8), 16, 10).cast("bigint") < share * float(1 << 32)


def wanted_share(count: int, k: int) -> float:
    """A share of ``count`` digests that has more than the k least of them, as good as always."""
    return min(1.0, (2 * k + 100) / max(count, 1))


def least_drawn(rows: DataFrame, draw: str, order: list, k: int) -> DataFrame:
    """The ``k`` rows that come first in ``order``, which begins with the digest ``draw``.

    Sorting a limit takes k rows of every task; here only rows that can be among the first leave their task. ``rows`` is
    read up to three times and should be narrow.
    """
    share = wanted_share(rows.count(), k)
    while share < 1:
        near = rows.filter(drawn_below(F.col(draw), share))
        if near.count() >= k:
            return near.orderBy(*order).limit(k)
        share = min(1.0, 4 * share)
    return rows.orderBy(*order).limit(k)
