"""Quality rules on repetition, from suffix arrays over the words of each text.

The suffixes of all documents of a slice are sorted at once: by document, then by their first words, then by
prefix doubling over those that are still tied. Only suffixes whose first ``least`` words come twice in their
document (and the places that doubling reads) take part, because no other begins a repeat that counts. The
longest common prefix of neighbours in that order gives, for each place, the longest run of words that
begins there and comes again in the text; these are the longest-common-prefix intervals' own lengths at
their leaves, and the union of their spans is that of all maximal repeated substrings.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.token_files import slices
from millrace.llm.words import PLACES, mixed, serving, widened, word_hashes

#: Words of the documents that a task sorts at a time; one longer document is sorted alone.
SLICE = 600_000
WHITE = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"

RULES = "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, repeat_chars bigint, longest_repeat bigint, repeats array<struct<first:int,last:int>>"
_SPANS = pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32())]))


def longest_repeats(words: np.ndarray, ends: np.ndarray, least: int) -> np.ndarray:
    """For every word, the longest run that begins there and comes again in its document; 0 below ``least``.

    ``words`` are hashes of the words of some documents in a row, ``ends`` the end of each document.
    """
    n = len(words)
    longest = np.zeros(n, np.int32)
    if n < least:
        return longest
    doc = np.repeat(np.arange(len(ends)), np.diff(np.r_[0, ends]))
    end = ends[doc]
    places = np.arange(n)
    start = places[places + least <= end]
    if not len(start):
        return longest
    key = (doc[start].astype(np.uint64) + np.uint64(1)) * PLACES[0]
    for i in range(least):
        key = mixed(key + words[start + i])
    order = np.argsort(key, kind="stable")
    tied = key[order][1:] == key[order][:-1]
    twice = np.zeros(len(start), bool)
    twice[order[1:][tied]] = True
    twice[order[:-1][tied]] = True
    active = start[twice]
    if not len(active):
        return longest

    # places that take part, in the order of document and first words; behind the end stand zeros
    part = np.unique(np.r_[active, (active + least)[active + least < end[active]]])
    index = np.full(n, -1, np.int64)
    index[part] = np.arange(len(part))
    first = np.zeros((least, len(part)), np.uint64)
    for i in range(least):
        inside = part + i < end[part]
        first[i, inside] = words[part[inside] + i]
    order = np.lexsort((*first[::-1], doc[part]))
    moved = (np.diff(first[:, order], axis=1) != 0).any(axis=0) | (np.diff(doc[part][order]) != 0)
    rank = np.empty(len(part), np.int64)
    rank[order] = np.maximum.accumulate(np.r_[0, np.where(moved, np.arange(1, len(part)), 0)])

    def later(at: np.ndarray, ranks: np.ndarray, k: int) -> np.ndarray:
        """Rank of the suffix k words on; -1 behind the document's end."""
        to = part[at] + k
        out = np.full(len(at), -1, np.int64)
        inside = to < end[part[at]]
        out[inside] = ranks[index[to[inside]]]
        return out

    levels, k = [(least, rank)], least
    counts = np.bincount(rank, minlength=len(part))
    open_ = np.flatnonzero(counts[rank] > 1)
    while len(open_):
        behind = later(open_, rank, k)
        order = np.lexsort((behind, rank[open_]))
        r, b = rank[open_][order], behind[order]
        fresh = np.r_[True, r[1:] != r[:-1]]
        group = np.maximum.accumulate(np.where(fresh, np.arange(len(r)), 0))
        differs = fresh | np.r_[True, b[1:] != b[:-1]]
        sub = np.maximum.accumulate(np.where(differs, np.arange(len(r)), 0))
        rank = rank.copy()
        rank[open_[order]] = r + (sub - group)
        k *= 2
        levels.append((k, rank))
        counts = np.bincount(rank, minlength=len(part))
        open_ = open_[counts[rank[open_]] > 1]

    suffixes = np.argsort(rank, kind="stable")
    a, b = suffixes[:-1], suffixes[1:]
    near = levels[0][1][a] == levels[0][1][b]
    a, b = a[near], b[near]
    common = np.zeros(len(a), np.int64)
    for k, ranks in reversed(levels):
        x, y = part[a] + common, part[b] + common
        inside = (x < end[part[a]]) & (y < end[part[b]])
        at_x, at_y = np.where(inside, index[np.minimum(x, n - 1)], -1), np.where(inside, index[np.minimum(y, n - 1)], -1)
        equal = (at_x >= 0) & (at_y >= 0)
        equal[equal] = ranks[at_x[equal]] == ranks[at_y[equal]]
        common[equal] += k
    for _ in range(least - 1):
        x, y = part[a] + common, part[b] + common
        inside = (x < end[part[a]]) & (y < end[part[b]])
        inside[inside] = words[x[inside]] == words[y[inside]]
        if not inside.any():
            break
        common[inside] += 1
    both = np.zeros(len(part), np.int64)
    np.maximum.at(both, a, common)
    np.maximum.at(both, b, common)
    longest[part] = both
    return longest


def _covered(lengths: np.ndarray) -> np.ndarray:
    """Words inside some run that begins at a place with that length."""
    begin = np.flatnonzero(lengths)
    change = np.zeros(len(lengths) + 1, np.int64)
    np.add.at(change, begin, 1)
    np.add.at(change, begin + lengths[begin], -1)
    return np.cumsum(change[:-1]) > 0


def _spans(covered: np.ndarray) -> list[dict]:
    edge = np.diff(np.r_[0, covered.astype(np.int8), 0])
    return [{"first": a, "last": b} for a, b in zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist(), strict=True)]


def measures(texts: list[str | None], least: int = 5) -> list[tuple]:
    """The columns of ``RULES`` for some texts."""
    split = [x.encode().split() if x else [] for x in texts]
    ends = np.cumsum([len(x) for x in split])
    hashes = [word_hashes(x) for x in split]
    lengths = longest_repeats(np.concatenate([*hashes, np.empty(0, np.uint64)]), ends, least)
    out = []
    for text, words, end in zip(texts, split, ends, strict=True):
        text = text or ""
        chars = len(text) - sum(text.count(c) for c in WHITE)
        symbols = sum(text.count(c) for c in SYMBOLS)
        lines = [x for x in text.split("\n") if x.strip(WHITE)]
        own = lengths[end - len(words) : end]
        if own.any():
            covered = _covered(own)
            windows = _covered(np.where(own > 0, least, 0))
            repeat_chars = sum(len(words[i].decode()) for i in np.flatnonzero(covered).tolist())
            repeat = int(windows.sum()), repeat_chars, int(own.max()), _spans(covered)
        else:
            repeat = 0, 0, 0, []
        out.append((len(words), chars, symbols, len(lines) - len(set(lines)), *repeat))
    return out


def _run(least: int):
    names = [x.split(" ")[0] for x in RULES.replace("<first:int,last:int>", "").split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for a, b in slices(texts, SLICE * 6):
                columns = list(zip(*measures(texts[a:b], least), strict=True))
                arrays = [pa.array(c, pa.int64()) for c in columns[:-1]] + [pa.array(columns[-1], _SPANS)]
                part = batch.slice(a, b - a)
                yield pa.RecordBatch.from_arrays([*part.columns, *arrays], [*part.schema.names, *names])

    return serving("quality rules", run), names


def repetition_measures(docs: DataFrame, least: int = 5) -> DataFrame:
    """``docs`` with the columns of ``RULES`` added, for every row; columns of these names are replaced.

    ``n_repeat_words`` counts the words in windows of ``least`` words that come twice or more in the text,
    ``repeat_chars`` the characters of the union of all repeated runs of at least ``least`` words,
    ``longest_repeat`` the words of the longest such run, and ``repeats`` their united spans (word numbers,
    last exclusive). A null or empty text has zeros and no spans.
    """
    run, names = _run(least)
    kept = docs.drop(*names)
    return widened(kept, run, RULES)


def quality_rules(
    docs: DataFrame, least_words: int = 10, repeat_percent: int = 20, repeat_char_percent: int = 20, longest: int = 200, least: int = 5
) -> DataFrame:
    """:func:`repetition_measures` with ``base_failed`` and ``kept``.

    ``base_failed``: fewer than ``least_words`` words, or more than ``repeat_percent`` of the words in repeated
    windows. ``kept`` also needs at most ``repeat_char_percent`` of the word characters inside repeated
    runs, and no repeated run of more than ``longest`` words. Empty and null texts fail.
    """
    measured = repetition_measures(docs.drop("base_failed", "kept"), least)
    words, repeated = F.col("n_words"), F.col("n_repeat_words")
    failed = (words < least_words) | (repeated * 100 > words * repeat_percent)
    heavy = (F.col("repeat_chars") * 100 > F.col("word_chars") * repeat_char_percent) | (F.col("longest_repeat") > longest)
    return measured.withColumn("base_failed", failed).withColumn("kept", ~failed & ~heavy)
