"""Benchmark passages in documents, by a prefix-filtered containment join of shingles.

Every run of ``size`` words of an item is a window (a shorter item is one window). A document contains a window
if all of the window's shingles stand in it, so one of them, the window's prefix, is enough to propose it.

1. The windows' shingles are counted over all documents, which gives their order by rarity.
2. The prefix of a window is its rarest shingle. Wherever a document has a prefix, its place in the window says
   where the window would begin: the place must lie in the document (positional bound) and leave room for
   the window (length bound).
3. What is proposed is looked up by the hash of all its words and then compared word for word.

Prefixes are kept once per (shingle, place in the window, window length), so a shingle that many windows share
costs at most that many looks. The windows are broadcast in blocks of about ``BLOCK`` (window, item) rows; a larger
benchmark takes one pass over the documents per block, and the passes add up to the whole result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.bytewords import Words, byte_table, find_words, slices_of, text_bytes
from millrace.llm.words import mixed, serving, widened
from millrace.session import materialise

#: Words are runs of digits, letters a to z and characters beyond ASCII, after A to Z are lower-cased.
ITEM_WORDS = byte_table([*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)])
#: (window, item) rows that one pass over the documents looks for.
BLOCK = 200_000
#: Words of a shingle.
WIDTH = 3

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
_BASE = 0x9E3779B97F4A7C15
_CHUNK = 1 << 20
_SPAN = pa.struct([("first", pa.int64()), ("last", pa.int64())])
_COLUMNS = "n_words bigint, hits array<struct<first:bigint,last:bigint>>, items array<string>"
_NAMES = ["n_words", "hits", "items"]
_WINDOWS = "item string, window string"


def _powers(base: int, count: int) -> np.ndarray:
    out = np.full(count, base % 2**64, np.uint64)
    out[:1] = 1
    return np.cumprod(out)


_UP, _DOWN = _powers(_BASE, _CHUNK + 1), _powers(pow(_BASE, -1, 2**64), _CHUNK + 1)
_PLACE = _powers(0xD6E8FEB86659FD93, 1024)


def words_of_texts(texts: pa.Array) -> Words:
    data, ends = text_bytes(texts)
    return find_words(_LOWER[data], ends, ITEM_WORDS)


def hashes_of(words: Words) -> np.ndarray:
    """A 64-bit hash per word: a polynomial in its bytes, taken from running sums over stretches of bytes."""
    out = np.empty(len(words.begin), np.uint64)
    first = 0
    while first < len(out):
        low = int(words.begin[first])
        last = max(first + 1, int(np.searchsorted(words.stop, low + _CHUNK, side="right")))
        size = int(words.stop[last - 1]) - low
        up, down = (_UP, _DOWN) if size <= _CHUNK else (_powers(_BASE, size + 1), _powers(pow(_BASE, -1, 2**64), size + 1))
        sums = np.zeros(size + 1, np.uint64)
        np.cumsum((words.data[low : low + size].astype(np.uint64) + np.uint64(1)) * up[:size], out=sums[1:])
        begin, stop = words.begin[first:last] - low, words.stop[first:last] - low
        out[first:last] = (sums[stop] - sums[begin]) * down[begin] + (stop - begin).astype(np.uint64)
        first = last
    return mixed(out)


def _stretches(hashes: np.ndarray, begin: np.ndarray, length: int) -> np.ndarray:
    """A hash per stretch of ``length`` words."""
    places = _PLACE if length <= len(_PLACE) else _powers(int(_PLACE[1]), length)
    total = np.full(len(begin), length, np.uint64)
    for i in range(length):
        total += hashes[begin + i] * places[i]
    return mixed(total)


def _fitting(ends: np.ndarray, length: int) -> np.ndarray:
    """First words of all stretches of ``length`` words inside one text."""
    size = int(ends[-1]) if len(ends) else 0
    own_end = np.repeat(ends, np.diff(ends, prepend=0))
    return np.flatnonzero(np.arange(size) + length <= own_end)


def _matches(table: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For sorted ``table``: which of ``values`` it holds, and where each of those begins in it."""
    bits = np.zeros(1 << 16, bool)
    bits[(table >> np.uint64(48)).astype(np.int64)] = True
    held = np.flatnonzero(bits[(values >> np.uint64(48)).astype(np.int64)]) if len(table) < 1 << 15 else np.arange(len(values))
    at = np.searchsorted(table, values[held])
    found = at < len(table)
    found[found] = table[at[found]] == values[held[found]]
    return held[found], at[found]


def _pairs(low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    counts = high - low
    owner = np.repeat(np.arange(len(counts)), counts)
    return owner, np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts) + low[owner]


@dataclass
class Block:
    """Some windows with their items, and what proposes them."""

    texts: list[bytes]
    #: Hash and length of each window, sorted by hash.
    hashes: np.ndarray
    lengths: np.ndarray
    #: The items of window i stand from first_item[i] to first_item[i + 1].
    first_item: np.ndarray
    items: pa.Array
    #: Words per shingle, to the distinct shingles of that length.
    shingles: dict[int, np.ndarray]
    #: Words per shingle, to the prefixes: shingle hash (sorted), its place in the window, window length.
    prefixes: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]

    @staticmethod
    def of(rows: pa.Table) -> tuple[Block, dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]]:
        """A block without prefixes, and per shingle length its shingles: hash, window, place."""
        rows = rows.sort_by([("window", "ascending"), ("item", "ascending")])
        coded = rows.column("window").combine_chunks().dictionary_encode()
        texts, of = coded.dictionary, coded.indices.to_numpy()
        words = words_of_texts(texts)
        hashes, lengths = hashes_of(words), np.diff(words.ends, prepend=0)
        first = words.ends - lengths
        whole = np.empty(len(texts), np.uint64)
        parts: dict[int, list] = {}
        for length in np.unique(lengths).tolist():
            own = np.flatnonzero(lengths == length)
            whole[own] = _stretches(hashes, first[own], length)
            width = min(WIDTH, length)
            for place in range(length - width + 1):
                parts.setdefault(width, []).append((_stretches(hashes, first[own] + place, width), own, np.full(len(own), place)))
        listed = {width: tuple(np.concatenate(x) for x in zip(*p, strict=True)) for width, p in parts.items()}
        order = np.argsort(whole, kind="stable")
        low = np.searchsorted(of, np.arange(len(texts) + 1))
        counts = np.diff(low)[order]
        _, taken = _pairs(low[order], low[order + 1])
        named = rows.column("item").combine_chunks().take(pa.array(taken))
        raw = texts.cast(pa.binary()).take(pa.array(order)).to_pylist()
        number = np.empty(len(order), np.int64)
        number[order] = np.arange(len(order))
        listed = {width: (h, number[own], place) for width, (h, own, place) in listed.items()}
        shingles = {width: np.unique(h) for width, (h, _, _) in listed.items()}
        return Block(raw, whole[order], lengths[order], np.r_[0, np.cumsum(counts)], named, shingles, {}), listed

    def choose(self, listed: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]], counts: dict[tuple[int, int], int]) -> None:
        """Take each window's rarest shingle as its prefix; ties go to the smaller hash, then the earlier place."""
        for width, (hashes, windows, places) in listed.items():
            seen = np.array([counts.get((width, h), 0) for h in self.shingles[width].astype(np.int64).tolist()], np.int64)
            rarity = seen[np.searchsorted(self.shingles[width], hashes)]
            order = np.lexsort((places, hashes, rarity, windows))
            best = order[np.r_[True, np.diff(windows[order]) != 0]]
            entries = np.unique(np.rec.fromarrays([hashes[best], places[best], self.lengths[windows[best]]], names="hash,place,length"))
            self.prefixes[width] = (entries["hash"], entries["place"], entries["length"])

    def found(self, words: Words) -> tuple[np.ndarray, np.ndarray]:
        """Every occurrence of a window: its first word, and the window."""
        hashes = hashes_of(words)
        proposed, lengths = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        own_begin, own_end = (np.repeat(x, np.diff(words.ends, prepend=0)) for x in (np.r_[0, words.ends[:-1]], words.ends))
        for width, (table, places, window_lengths) in self.prefixes.items():
            begin = _fitting(words.ends, width)
            held, low = _matches(table, _stretches(hashes, begin, width))
            at, (owner, entry) = begin[held], _pairs(low, np.searchsorted(table, table[low], side="right"))
            start = at[owner] - places[entry]
            bounds = (start >= own_begin[at[owner]]) & (start + window_lengths[entry] <= own_end[at[owner]])
            proposed.append(start[bounds])
            lengths.append(window_lengths[entry][bounds])
        start, length = np.concatenate(proposed), np.concatenate(lengths)
        out = [(np.empty(0, np.int64), np.empty(0, np.int64))]
        for size in np.unique(length).tolist():
            begin = np.unique(start[length == size])
            held, low = _matches(self.hashes, _stretches(hashes, begin, size))
            owner, window = _pairs(low, np.searchsorted(self.hashes, self.hashes[low], side="right"))
            begin = begin[held][owner]
            same = self.equal(words, begin, window, size)
            out.append((begin[same], window[same]))
        return tuple(np.concatenate(x) for x in zip(*out, strict=True))

    def equal(self, words: Words, begin: np.ndarray, window: np.ndarray, size: int) -> np.ndarray:
        """Whether the ``size`` words from ``begin`` on are those of the window."""
        data, stops = words.data, words.stop
        same = np.empty(len(begin), bool)
        for i, (b, w) in enumerate(zip(begin.tolist(), window.tolist(), strict=True)):
            text = b" ".join(data[x:y].tobytes() for x, y in zip(words.begin[b : b + size].tolist(), stops[b : b + size].tolist(), strict=True))
            same[i] = text == self.texts[w]
        return same


def _windows(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices_of(batch, "text"):
                words = words_of_texts(part.column("text"))
                array, ids = words.array().cast(pa.large_string()), part.column("item")
                counts = np.diff(words.ends, prepend=0)
                sizes = np.minimum(counts, size)
                owner, begin = _pairs(words.ends - counts, np.where(counts > 0, words.ends - sizes + 1, words.ends - counts))
                offsets = np.r_[0, np.cumsum(sizes[owner])].astype(np.int32)
                _, taken = _pairs(begin, begin + sizes[owner])
                lists = pa.ListArray.from_arrays(offsets, array.take(pa.array(taken)))
                texts = pc.binary_join(lists, pa.scalar(" ", pa.large_string())).cast(pa.string())
                yield pa.RecordBatch.from_arrays([ids.take(pa.array(owner)).cast(pa.string()), texts], ["item", "window"])

    return run


def windows_of(items: DataFrame, key: str, size: int = 10) -> DataFrame:
    """``item, window`` for every distinct window of every item; the window's words are joined by one space."""
    texts = items.select(F.col(key).cast("string").alias("item"), "text")
    return texts.mapInArrow(serving("windows", _windows(size)), _WINDOWS).distinct()


def _counted(shingles):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = shingles.value
        totals = {width: np.zeros(len(table), np.int64) for width, table in tables.items()}
        for batch in batches:
            for part in slices_of(batch, "text"):
                words = words_of_texts(part.column("text"))
                hashes = hashes_of(words)
                for width, table in tables.items():
                    _, at = _matches(table, _stretches(hashes, _fitting(words.ends, width), width))
                    totals[width] += np.bincount(at, minlength=len(table))
        for width, total in totals.items():
            seen = np.flatnonzero(total)
            arrays = [np.full(len(seen), width, np.int32), tables[width][seen].view(np.int64), total[seen]]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in arrays], ["width", "shingle", "count"])

    return run


def _lists(owner: np.ndarray, count: int, values: pa.Array) -> pa.ListArray:
    """Values sorted by owner as a list per owner."""
    return pa.ListArray.from_arrays(np.searchsorted(owner, np.arange(count + 1)).astype(np.int32), values)


def _flat(lists: pa.Array) -> tuple[np.ndarray, pa.Array]:
    return pc.list_parent_indices(lists).to_numpy(), pc.list_flatten(lists)


def _marked(block, width: int):
    """Adds what the block's windows hit to batches whose first ``width`` columns are the documents'."""

    def columns(part: pa.RecordBatch) -> list[pa.Array]:
        words = words_of_texts(part.column("text"))
        texts = len(words.ends)
        first_word = words.ends - np.diff(words.ends, prepend=0)
        begin, window = block.value.found(words)
        change = np.zeros(len(words.begin) + 1, np.int64)
        np.add.at(change, begin, 1)
        np.add.at(change, begin + block.value.lengths[window], -1)
        text = np.searchsorted(words.ends, begin, side="right")
        key = np.unique(text * np.int64(len(block.value.texts)) + window)
        owner, window = key // max(len(block.value.texts), 1), key % max(len(block.value.texts), 1)
        pair, taken = _pairs(block.value.first_item[window], block.value.first_item[window + 1])
        owner, items = owner[pair], block.value.items.take(pa.array(taken))
        if part.num_columns > width:  # of an earlier pass
            row, spans = _flat(part.columns[-2])
            np.add.at(change, first_word[row] + pc.struct_field(spans, "first").to_numpy(), 1)
            np.add.at(change, first_word[row] + pc.struct_field(spans, "last").to_numpy(), -1)
            row, before = _flat(part.columns[-1])
            owner, items = np.r_[row, owner], pa.concat_arrays([before, items])
        listed = pa.table({"owner": owner, "item": items}).filter(pc.field("item").is_valid()).group_by(["owner", "item"]).aggregate([])
        listed = listed.sort_by([("owner", "ascending"), ("item", "ascending")])
        # a text's hits end with it, also where the next text begins with a hit
        hit = np.cumsum(change[:-1]) > 0
        after = np.r_[hit[1:], False] if len(hit) else hit
        before = np.r_[False, hit[:-1]] if len(hit) else hit
        filled = words.ends > first_word
        before[first_word[filled]], after[words.ends[filled] - 1] = False, False
        low, high = np.flatnonzero(hit & ~before), np.flatnonzero(hit & ~after) + 1
        row = np.searchsorted(words.ends, low, side="right")
        spans = pa.StructArray.from_arrays([pa.array(low - first_word[row]), pa.array(high - first_word[row])], fields=list(_SPAN))
        items = listed.column("item").combine_chunks().cast(pa.string())
        return [pa.array(words.ends - first_word), _lists(row, texts, spans), _lists(listed.column("owner").to_numpy(), texts, items)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices_of(batch, "text"):
                yield pa.RecordBatch.from_arrays([*part.columns[:width], *columns(part)], [*part.schema.names[:width], *_NAMES])

    return run


def benchmark_hits(docs: DataFrame, benchmark: DataFrame, key: str = "item_id", size: int = 10, block: int = BLOCK) -> DataFrame:
    """``docs`` with ``n_words``, ``hits`` and ``items`` added for every row; columns of these names are replaced.

    ``hits`` are the united spans (word numbers, last exclusive) of all occurrences of windows of ``benchmark``
    (``key``, ``text``), ``items`` the sorted ids of the items with a window that occurs, as text. Texts without
    words, null ones among them, have no windows and no hits; so has everything with an empty benchmark. Rows with
    one item id are one item; the windows of items without id hit, but there is no id to list. Repeated rows and
    null ids of documents are kept as they are.
    """
    session = docs.sparkSession
    kept = docs.drop(*_NAMES)
    windows = materialise(windows_of(benchmark, key, size), "windows")
    blocks = max(1, -(-windows.count() // block))
    marked = kept
    for i in range(blocks):
        rows = windows if blocks == 1 else windows.filter(F.pmod(F.xxhash64("item", "window"), F.lit(blocks)) == i)
        found, listed = Block.of(rows.toArrow())
        shingles = session.sparkContext.broadcast(found.shingles)
        counted = kept.select("text").mapInArrow(serving("rarity", _counted(shingles)), "width int, shingle bigint, count bigint")
        counts = counted.groupBy("width", "shingle").agg(F.sum("count").alias("count")).collect() if found.shingles else []
        found.choose(listed, {(r["width"], r["shingle"]): r["count"] for r in counts})
        held = session.sparkContext.broadcast(found)
        marked = widened(marked, serving("benchmark hits", _marked(held, len(kept.columns))), _COLUMNS if i == 0 else "")
        if i + 1 < blocks:
            marked = materialise(marked, "benchmark-hits")
    return marked
