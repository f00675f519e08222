"""Document fingerprints by one-permutation MinHash.

Each word shingle of a text is hashed once. The top bits of the hash are its bin and the least remainder is
the bin's value. An empty bin takes the value of a full bin that a fixed walk of universal hashes finds
(optimal densification), so two texts' bins agree with the probability of their Jaccard similarity. Only the
low bits of every bin are stored, packed; likeness takes chance agreement of those bits out again.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.ranges import with_ranges
from millrace.llm.words import begin, mixed, shingle_hashes, split_words, widened, word_hashes


class OnePermutation:
    """Fingerprints of ``2**bin_bits`` bins with ``stored_bits`` (1, 2, 4 or 8) bits each."""

    def __init__(self, bin_bits: int = 8, stored_bits: int = 8, width: int = 5):
        self.bin_bits, self.bits, self.width = bin_bits, stored_bits, width
        self.bins = 1 << bin_bits
        self.edges = np.arange(self.bins, dtype=np.uint64) << np.uint64(64 - bin_bits)
        self._walks = np.empty((0, self.bins), np.int64)

    def _walk(self, step: int) -> np.ndarray:
        """The bin that each empty bin asks at a step of its walk."""
        while step >= len(self._walks):
            rows = np.arange(len(self._walks), len(self._walks) + 64, dtype=np.uint64)[:, None]
            asked = mixed(rows * np.uint64(self.bins) + np.arange(self.bins, dtype=np.uint64) + np.uint64(1))
            self._walks = np.vstack([self._walks, (asked >> np.uint64(64 - self.bin_bits)).astype(np.int64)])
        return self._walks[step]

    def values(self, text: bytes | None) -> np.ndarray | None:
        """The stored low bits of each bin; None for a text without words."""
        hashes = np.sort(shingle_hashes(word_hashes(split_words(text)), self.width))
        if not len(hashes):
            return None
        first = np.searchsorted(hashes, self.edges)
        found = hashes[np.minimum(first, len(hashes) - 1)]
        full = (first < len(hashes)) & (found >> np.uint64(64 - self.bin_bits) == np.arange(self.bins, dtype=np.uint64))
        empty, step = np.flatnonzero(~full), 0
        while len(empty):
            asked = self._walk(step)[empty]
            hit = full[asked]
            found[empty[hit]] = found[asked[hit]]
            empty, step = empty[~hit], step + 1
        return (mixed(found) & np.uint64((1 << self.bits) - 1)).astype(np.uint8)

    def packed(self, values: np.ndarray | None) -> str:
        """Hexadecimal text of the packed bits; empty for a text without words."""
        if values is None:
            return ""
        per = 8 // self.bits
        groups = values.reshape(-1, per)
        out = np.zeros(len(groups), np.uint8)
        for i in range(per):
            out |= groups[:, i] << np.uint8(i * self.bits)
        return out.tobytes().hex()

    def unpacked(self, fingerprint: str) -> np.ndarray | None:
        if not fingerprint:
            return None
        stored = np.frombuffer(bytes.fromhex(fingerprint), np.uint8)
        per, mask = 8 // self.bits, np.uint8((1 << self.bits) - 1)
        return np.stack([stored >> np.uint8(i * self.bits) & mask for i in range(per)], axis=1).reshape(-1)

    def likeness(self, a: np.ndarray | None, b: np.ndarray | None) -> float:
        """Estimated Jaccard similarity, 0 to 1; two texts without words are alike, one is unlike any other."""
        if a is None or b is None:
            return float(a is b)
        chance = 1 / (1 << self.bits)
        return float(min(1.0, max(0.0, (np.mean(a == b) - chance) / (1 - chance))))


def _edited(text: str, following: str) -> str:
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


_OUT = "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
_OUT_ARROW = pa.schema(
    [("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
     ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64())]
)


def fingerprints(docs: DataFrame, scheme: OnePermutation | None = None) -> DataFrame:
    """``docs`` with ``fingerprint`` added (replaced if there); null and empty texts have the empty one."""
    scheme = scheme or OnePermutation()
    kept = docs.drop("fingerprint")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = [scheme.packed(scheme.values(x)) for x in batch.column("text").cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(prints, pa.string())], [*batch.schema.names, "fingerprint"])

    return widened(kept, run, "fingerprint string")


def in_id_order(docs: DataFrame) -> DataFrame:
    """``(part, closing, doc_id, text)`` dealt by ranges of doc_id and sorted inside them.

    Every part ends with a closing row that repeats the next part's first document, the last part with the
    very first document, so a task sees each document's follower without the others' rows. A missing
    doc_id comes first; equal ids stand by a hash of the text. The ranges are quantiles of doc_id, and a part's first
    document is a partial aggregation, so nothing but the quantiles passes through the driver.
    """
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    dealt, parts = with_ranges(rows)
    dealt = dealt.withColumn("closing", F.lit(False))
    first = dealt.groupBy("part").agg(F.min(F.struct(F.col("doc_id").isNotNull().alias("known"), "doc_id", "turn", "text")).alias("head"))
    # one row for each part from here on
    place = Window.orderBy("part")
    everyone = Window.partitionBy()
    owner = F.coalesce(F.lag("part").over(place), F.max("part").over(everyone))
    heads = first.select(owner.alias("part"), F.lit(True).alias("closing"), *[F.col(f"head.{c}").alias(c) for c in ("doc_id", "turn", "text")])
    both = dealt.select("part", "closing", "doc_id", "turn", "text").union(heads)
    return both.repartitionById(parts, F.col("part")).sortWithinPartitions("part", "closing", "doc_id", "turn", "text")


def edit_likeness(docs: DataFrame, scheme: OnePermutation | None = None) -> DataFrame:
    """Fingerprint each text and its edited text, and compare it with that and with the next document's.

    The edited text has the last ``floor(n_chars / 2)`` code points replaced by the first as many (or all) of
    the next document in ascending doc_id, the first document following the last. Likeness is estimated
    from the stored bits alone. Null texts count as empty; an empty text's edit is empty. One document
    follows itself; an empty table gives none. Other columns of ``docs`` are not read.
    """
    scheme = scheme or OnePermutation()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin("fingerprints")
        held = None
        for batch in batches:
            out = []
            columns = (batch.column(c).to_pylist() for c in ("closing", "doc_id", "text"))
            for closing, doc_id, text in zip(*columns, strict=True):
                values = scheme.values(text.encode())
                if held:
                    own_id, own_text, own = held
                    changed = _edited(own_text, text)
                    edited = own if changed == own_text else scheme.values(changed.encode())
                    digest = hashlib.sha256(changed.encode()).hexdigest()
                    prints = scheme.packed(own), scheme.packed(edited)
                    out.append((own_id, len(own_text), digest, *prints, scheme.likeness(own, edited), scheme.likeness(own, values)))
                held = None if closing else (doc_id, text, values)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), _OUT_ARROW, strict=True)], schema=_OUT_ARROW)

    return in_id_order(docs).mapInArrow(run, _OUT)
