"""Words, word hashes and word shingles of whole texts, for code that runs inside tasks."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql.types import StructField, StructType

#: Entries of a per-process cache before it is emptied; bounds memory, never results.
CACHE_ENTRIES = 200_000

#: Odd multipliers, one for each place in a shingle, repeated for longer shingles.
PLACES = np.array(
    [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], dtype=np.uint64
)


class Cache(dict):
    """A dict that fills itself with ``make(key)``; :meth:`trim` empties it when it has grown too large."""

    def __init__(self, make, entries: int = CACHE_ENTRIES):
        super().__init__()
        self.make = make
        self.entries = entries

    def __missing__(self, key):
        value = self[key] = self.make(key)
        return value

    def trim(self) -> None:
        if len(self) > self.entries:
            self.clear()


class LastingCache(Cache):
    """A cache that lets go of what was not asked for lately: two generations instead of emptying it whole.

    :meth:`trim` makes the young entries the old ones when there are too many; what is asked for again moves back.
    """

    def __init__(self, make, entries: int = CACHE_ENTRIES):
        super().__init__(make, entries)
        self.old: dict = {}

    def __missing__(self, key):
        value = self.old.pop(key, None)
        if value is None:
            value = self.make(key)
        self[key] = value
        return value

    def trim(self) -> None:
        if len(self) > self.entries:
            self.old = dict(self)
            self.clear()


_HASHES = Cache(xxhash.xxh3_64_intdigest)
_RELEASES: list[Callable[[], None]] = [_HASHES.clear]
_CURRENT = ""


def keep_until_other(release: Callable[[], None]) -> None:
    """Have something that a process keeps between tasks let go when another operator's task begins."""
    _RELEASES.append(release)


def begin(operator: str) -> None:
    """Say whose task begins: a worker that serves several operators only holds the caches of one."""
    global _CURRENT
    if operator != _CURRENT:
        for release in _RELEASES:
            release()
        hand_back()
        _CURRENT = operator


def hand_back() -> None:
    """Return freed memory to the system, also that which the C library keeps for later."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def serving(operator: str, run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """``run`` as a task of ``operator`` that leaves a small worker behind.

    Spark keeps workers for later tasks while stages in the JVM need the executor's memory.
    """

    def task(batches: Iterator) -> Iterator:
        begin(operator)
        yield from run(batches)
        _HASHES.clear()
        hand_back()

    return task


def widened(kept: DataFrame, run: Callable[[Iterator], Iterator], added: str) -> DataFrame:
    """``kept`` with the columns of a DDL text that ``run`` adds to its record batches.

    Columns go to the tasks under plain names, so names and types of any kind pass unchanged.
    """
    fields = [*kept.schema.fields, *(StructType.fromDDL(added).fields if added else [])]
    names, plain = [f.name for f in fields], [f"c{i}" for i in range(len(fields))]
    given = names[: len(kept.columns)]

    def task(batches: Iterator) -> Iterator:
        for batch in run(x.rename_columns(given) for x in batches):
            yield batch.rename_columns(plain)

    schema = StructType([StructField(n, f.dataType) for n, f in zip(plain, fields, strict=True)])
    return kept.toDF(*plain[: len(given)]).mapInArrow(task, schema).toDF(*names)


def split_words(text: bytes | None) -> list[bytes]:
    """Runs of anything but space and U+0009 to U+000D; no words for a missing text."""
    return text.split() if text else []


def word_hashes(words: list[bytes]) -> np.ndarray:
    """A 64-bit hash per word."""
    _HASHES.trim()
    return np.fromiter(map(_HASHES.__getitem__, words), np.uint64, len(words))


def mixed(values: np.ndarray) -> np.ndarray:
    """Spread every input bit over all output bits (a bijection on 64-bit values)."""
    values = values ^ (values >> np.uint64(33))
    values = values * np.uint64(0xFF51AFD7ED558CCD)
    values = values ^ (values >> np.uint64(33))
    values = values * np.uint64(0xC4CEB9FE1A85EC53)
    return values ^ (values >> np.uint64(33))


def shingle_hashes(hashes: np.ndarray, width: int = 5) -> np.ndarray:
    """One hash per run of ``width`` words; a shorter sequence is one shingle; no words give none."""
    if not len(hashes):
        return hashes
    width = min(width, len(hashes))
    count = len(hashes) - width + 1
    total = np.full(count, width, dtype=np.uint64)
    for place in range(width):
        total += hashes[place : place + count] * PLACES[place % len(PLACES)]
    return mixed(total)
