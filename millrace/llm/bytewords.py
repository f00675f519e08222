"""Words of many texts at once, read from the bytes of an Arrow column, for code that runs inside tasks.

A byte either belongs to words or separates them, so words are stretches of a table lookup. Bytes from 0x80 on
belong to words in every table used here, which keeps characters of several bytes whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

#: Bytes of text that a task looks at together; one longer text is looked at alone.
SLICE_BYTES = 2 << 20


def byte_table(separators: Iterator[int] | range | bytes) -> np.ndarray:
    """True for every byte that belongs to words."""
    table = np.ones(256, bool)
    table[list(separators)] = False
    return table


#: Words are runs of anything but space and U+0009 to U+000D.
NON_SPACE = byte_table([0x20, *range(0x09, 0x0E)])


@dataclass
class Words:
    """The words of some texts: where each begins and stops in ``data``, and the word count up to each text's end."""

    data: np.ndarray
    begin: np.ndarray
    stop: np.ndarray
    ends: np.ndarray

    def array(self) -> pa.LargeBinaryArray:
        """The words as an Arrow array."""
        lengths = self.stop - self.begin
        offsets = np.zeros(len(lengths) + 1, np.int64)
        np.cumsum(lengths, out=offsets[1:])
        edge = np.zeros(len(self.data) + 1, np.int8)
        edge[self.begin] += 1
        edge[self.stop] -= 1
        packed = self.data[np.cumsum(edge[:-1], dtype=np.int8).view(bool)]
        return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(lengths), [None, pa.py_buffer(offsets), pa.py_buffer(packed)])

    def text_of(self) -> np.ndarray:
        """The number of the text of each word."""
        return np.repeat(np.arange(len(self.ends)), np.diff(self.ends, prepend=0))


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a text column and the end of each text in them; null texts are empty."""
    column = column.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    body = column.buffers()[2]
    data = np.frombuffer(body, np.uint8)[offsets[0] : offsets[-1]] if body is not None else np.empty(0, np.uint8)
    return data, offsets[1:] - offsets[0]


def find_words(data: np.ndarray, text_ends: np.ndarray, table: np.ndarray) -> Words:
    """Words of texts that stand one after the other in ``data``; no word runs from one text into the next."""
    inside = table[data]
    borders = text_ends[(text_ends > 0) & (text_ends < len(data))]
    before, after = np.zeros_like(inside), np.zeros_like(inside)
    before[1:], after[:-1] = inside[:-1], inside[1:]
    before[borders] = False
    after[borders - 1] = False
    begin, stop = np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1
    return Words(data, begin, stop, np.searchsorted(begin, text_ends, side="left"))


def slices_of(batch: pa.RecordBatch, column: str, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Parts of a batch whose texts have at most ``most`` bytes together, or that are one row."""
    _, ends = text_bytes(batch.column(column))
    start, taken = 0, 0
    while start < len(ends):
        stop = max(start + 1, int(np.searchsorted(ends, taken + most, side="right")))
        yield batch.slice(start, stop - start)
        taken, start = int(ends[stop - 1]), stop
