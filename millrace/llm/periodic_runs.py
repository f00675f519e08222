"""Periodic runs of words, found with a dictionary of basic factors.

A basic factor is a stretch of 2**k words; equal factors of one text have one name, and the names of level k + 1
are those of pairs of names of level k. A run whose smallest period q lies in [m, 2m), m = 2**k, holds its first
m words twice, q words apart. The occurrences of one factor that are at most m / 2 apart stand in arithmetic
progressions (their step is the factor's own period), so the periods to look at are few: the distances, from m
to below 2m, between the last members of two progressions, and between the first member of one and the earlier
occurrences. A stretch of such proposals with one period is one run at most. Each is extended to both sides by
comparing names from the longest factors down, which gives maximal runs; multiples of a period give the same
stretch as the period itself and go.

Several texts are handled at once. Names are given per text and every text ends with a name of its own, so no
run and no comparison passes from one text to the next.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from millrace.llm.bytewords import NON_SPACE, find_words, slices_of, text_bytes
from millrace.llm.words import serving, widened

_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
_COLUMNS = "n_words bigint, runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string"
_NAMES = ["n_words", "runs", "collapsed"]


def _named(keys: np.ndarray, at: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Names for the places ``at`` by their ``keys``.

    Returns a name per place of the text (equal keys that come twice or more: a number from 0 on; everything
    else: a negative number of its own), the places with repeated keys sorted by name and place, and their names.
    """
    if not len(keys):
        return np.empty(0, np.int32), at, keys
    order = np.argsort(keys, kind="stable")
    sorted_ = keys[order]
    same = sorted_[1:] == sorted_[:-1]
    repeated = np.r_[same, False] | np.r_[False, same]
    fresh = np.r_[True, ~same] & repeated
    names = (np.cumsum(fresh) - 1)[repeated]
    places = at[order][repeated]
    dense = -1 - np.arange(size, dtype=np.int32)
    dense[places] = names
    return dense, places, names


def _ranges(low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Every number of [low, high) for each pair, with the number of the pair."""
    counts = np.maximum(high - low, 0)
    owner = np.repeat(np.arange(len(counts)), counts)
    return owner, np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts) + low[owner]


def _proposals(places: np.ndarray, names: np.ndarray, m: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and periods in [m, 2m) proposed by the occurrences of the factors of m words."""
    step = np.diff(places)
    apart = (np.diff(names) != 0) | (step > m // 2)
    firsts, lasts = np.flatnonzero(np.r_[True, apart]), np.flatnonzero(np.r_[apart, True])
    span = size + 2 * m + 1  # keys of two names are further apart than any period
    keys = names.astype(np.int64) * span + places
    ends = keys[lasts]
    i, j = _ranges(np.searchsorted(ends, ends + m), np.searchsorted(ends, ends + 2 * m))
    heads = keys[firsts]
    k, x = _ranges(np.searchsorted(keys, heads - 2 * m, side="right"), np.searchsorted(keys, heads - m, side="right"))
    at = np.r_[places[lasts][i], places[x]]
    periods = np.r_[places[lasts][j], places[firsts][k]] - at
    order = np.lexsort((at, periods))
    at, periods = at[order], periods[order]
    # neighbours with one period lie in one run: the first of them stands for all
    fresh = np.ones(len(at), bool)
    fresh[1:] = (np.diff(periods) != 0) | (np.diff(at) > 1)
    return at[fresh], periods[fresh]


def find_runs(ids: np.ndarray, ends: np.ndarray, least: int = 12) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All runs of at least ``least`` words and twice their period: first word, length, smallest period.

    ``ids`` are the words of some texts in a row as numbers, ``ends`` the end of each text; the words of the
    result are counted from the beginning of ``ids``. Sorted by first word, then period.
    """
    size = len(ids) + len(ends)
    text = np.repeat(np.arange(len(ends)), np.diff(ends, prepend=0))
    at = np.arange(len(ids)) + text  # each text is followed by one place without a word
    none = np.empty(0, np.int64)
    if not len(ids):
        return none, none, none
    levels, found = [], []
    names, places, of = _named(text * (np.int64(ids.max()) + 1) + ids, at, size)
    m = 1
    while len(places):
        levels.append(names)
        found.append(_proposals(places, of, m, size))
        behind = places + m
        both = behind < size
        both[both] = names[behind[both]] >= 0
        keys = names[places[both]].astype(np.int64) * (len(places) + 1) + names[behind[both]]
        names, places, of = _named(keys, places[both], size)
        m *= 2
    if not found:
        return none, none, none
    left, period = (np.concatenate(x) for x in zip(*found, strict=True))
    right = left + period
    ahead, back = np.zeros(len(left), np.int64), np.zeros(len(left), np.int64)
    for k in range(len(levels) - 1, -1, -1):
        level, m = levels[k], 1 << k
        to = right + ahead
        equal = to + m <= size
        equal[equal] = level[(left + ahead)[equal]] == level[to[equal]]
        ahead[equal] += m
        to = left - back - m
        equal = to >= 0
        equal[equal] = level[to[equal]] == level[(right - back - m)[equal]]
        back[equal] += m
    start, length = left - back, back + period + ahead
    runs = (length >= 2 * period) & (length >= least)
    start, length, period = start[runs], length[runs], period[runs]
    order = np.lexsort((period, length, start))
    start, length, period = start[order], length[order], period[order]
    smallest = np.ones(len(start), bool)
    smallest[1:] = (np.diff(start) != 0) | (np.diff(length) != 0)
    start, length, period = start[smallest], length[smallest], period[smallest]
    # back to word numbers without the places between texts
    start = start - np.searchsorted(ends + np.arange(1, len(ends) + 1), start, side="right")
    order = np.lexsort((period, start))
    return start[order], length[order], period[order]


def repeated_part(start: np.ndarray, length: np.ndarray, period: np.ndarray, size: int) -> np.ndarray:
    """True for every word that some run contains after its first period."""
    change = np.zeros(size + 1, np.int64)
    np.add.at(change, start + period, 1)
    np.add.at(change, start + length, -1)
    return np.cumsum(change[:-1]) > 0


def _columns(texts: pa.Array, least: int) -> list[pa.Array]:
    words = find_words(*text_bytes(texts), NON_SPACE)
    array = words.array()
    ids = array.dictionary_encode().indices.to_numpy()
    start, length, period = find_runs(ids, words.ends, least)
    own = np.searchsorted(words.ends, start, side="right")
    first_word = np.r_[0, words.ends[:-1]]
    run = pa.StructArray.from_arrays([pa.array(start - first_word[own]), pa.array(length), pa.array(period)], fields=list(_RUN))
    runs = pa.ListArray.from_arrays(np.r_[0, np.searchsorted(own, np.arange(len(words.ends)), side="right")].astype(np.int32), run)
    kept = ~repeated_part(start, length, period, len(ids))
    stops = np.r_[0, np.cumsum(kept)][np.r_[0, words.ends]]
    parts = pa.ListArray.from_arrays(stops.astype(np.int32), array.filter(pa.array(kept)).cast(pa.large_string()))
    return [pa.array(np.diff(words.ends, prepend=0)), runs, pc.binary_join(parts, pa.scalar(" ", pa.large_string())).cast(pa.string())]


def periodic_runs(docs: DataFrame, least: int = 12) -> DataFrame:
    """``docs`` with ``n_words``, ``runs`` and ``collapsed`` added for every row; columns of these names are replaced.

    Words are runs of anything but space and U+0009 to U+000D, numbered from 0. A run is a stretch of words with
    smallest period q (words q apart are equal) and at least ``max(least, 2 q)`` words that no neighbouring word
    extends with that period; ``runs`` has every run as (start, length, period), by start, then period.
    ``collapsed`` is the text without the words that some run contains after its first period, joined by one
    space. Null and empty texts have no words, no runs and an empty ``collapsed``. Rows are independent of
    each other: repeated rows, null ids and further columns are kept as they are. A text is worked on whole, in
    memory in proportion to its length times the logarithm of its longest repeated stretch.
    """
    kept = docs.drop(*_NAMES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices_of(batch, "text"):
                yield pa.RecordBatch.from_arrays([*part.columns, *_columns(part.column("text"), least)], [*part.schema.names, *_NAMES])

    return widened(kept, serving("periodic runs", run), _COLUMNS)
