"""Language identification by compression.

For each language a zstandard dictionary of raw content is made from a bounded sample of labelled texts. A
text is encoded once with every dictionary; the language whose dictionary makes it smallest is the answer,
the languages' shares of the labelled rows counting as code lengths of their own.
When the best is smaller than the second by less than a narrow margin, the answer is marked as rejected.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.sampling import draw_of, drawn_below, wanted_share
from millrace.llm.words import begin, widened

UNKNOWN = "und"
#: Bytes that are encoded together; each piece of a longer text starts from the dictionary again.
PIECE = 8192


def remainder(doc_id: str, modulus: int) -> Column:
    """crc32 of the id's text modulo a number; a missing id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % modulus


def shared_out(texts: list[list[bytes]], room: int) -> bytes:
    """A stretch of every piece of every text, so that no text has more of the room than another needs.

    Texts shorter than an even share are whole; the others divide what is left evenly among them, and each
    divides its part evenly among its pieces.
    """
    need = sorted(sum(len(p) for p in pieces) + len(pieces) for pieces in texts)
    share, left = 0, room
    for i, size in enumerate(need):
        share = left // (len(need) - i)
        if size > share:
            break
        left -= size
        share = size
    out = []
    for pieces in texts:
        each = max(0, share // len(pieces) - 1)
        out += [p if sum(map(len, pieces)) + len(pieces) <= share else p[:each] for p in pieces]
    return b"\n".join(x for x in out if x)


def fit(
    labelled: DataFrame, documents: int = 300, pieces: int = 8, chars: int = 500, dictionary_bytes: int = 1 << 18
) -> dict[str, tuple[bytes, float]]:
    """Dictionary content and share of the rows for each non-null ``lang`` of ``labelled(doc_id, text, lang)``.

    The sample is bounded: of every language the ``documents`` texts with the least md5(doc_id), and of each
    ``pieces`` stretches of ``chars`` characters at even distances from its beginning to its end (the whole text, if
    that is shorter), in lower case. All these documents share the ``dictionary_bytes`` evenly. Rows whose digest
    is too large for the sample are left out before anything is shuffled, so a language has about twice ``documents`` rows in
    its task, however many rows or tasks the table has.
    """
    usable = labelled.filter("lang is not null and length(text) > 0")
    counts = {row["lang"]: row["count"] for row in usable.groupBy("lang").count().collect()}
    shares = {lang: wanted_share(count, documents) for lang, count in counts.items()}
    spare = F.length("text") - chars
    stretches = [F.substring(F.col("text"), F.floor(spare * (i / max(1, pieces - 1))).cast("int") + 1, F.lit(chars)) for i in range(pieces)]
    sampled = F.when(F.length("text") <= pieces * chars, F.array("text")).otherwise(F.array(*stretches))
    place = F.row_number().over(Window.partitionBy("lang").orderBy("draw", "texts"))
    texts: dict[str, list[tuple]] = {}
    short = set(shares)
    while short:
        # only rows that can be among the least drawn leave their task
        share = F.try_element_at(F.create_map(*[F.lit(x) for lang in sorted(short) for x in (lang, shares[lang])]), F.col("lang"))
        near = usable.withColumn("draw", draw_of()).filter(drawn_below(F.col("draw"), share) | (share >= 1))
        sample = near.select("lang", sampled.alias("texts"), "draw").withColumn("place", place).filter(F.col("place") <= documents)
        for lang in short:
            texts[lang] = []
        for row in sample.collect():
            texts[row["lang"]].append((row["place"], [x.lower().encode() for x in row["texts"]]))
        short = {lang for lang in short if len(texts[lang]) < min(documents, counts[lang]) and shares[lang] < 1}
        shares |= {lang: min(1.0, 4 * shares[lang]) for lang in short}
    total = sum(counts.values())
    return {lang: (shared_out([p for _, p in sorted(own)], dictionary_bytes), counts[lang] / total) for lang, own in sorted(texts.items())}


class Compressors:
    """One compressor per language."""

    def __init__(self, learned: dict[str, tuple[bytes, float]], level: int = 6):
        self.languages = list(learned)
        self.priors = [-math.log2(share) / 8 for _, share in learned.values()]
        self.coders = []
        for content, _ in learned.values():
            held = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            held.precompute_compress(level=level)
            self.coders.append(zstandard.ZstdCompressor(level=level, dict_data=held, write_content_size=False, write_checksum=False, write_dict_id=False))

    def sizes(self, text: bytes) -> list[float]:
        """Bytes of the text and of its language's name, for each language."""
        pieces = [text[i : i + PIECE] for i in range(0, len(text), PIECE)]
        return [prior + sum(len(coder.compress(x)) for x in pieces) for coder, prior in zip(self.coders, self.priors, strict=True)]

    def predict(self, text: str | None, margin: float) -> tuple[str, float, bool]:
        """Language, score and whether it is rejected; texts without a letter have no language."""
        if not text or not self.coders or not any(map(str.isalpha, text)):
            return UNKNOWN, 0.0, True
        sizes = self.sizes(text.lower().encode())
        best = min(sizes)
        rivals = sorted(sizes)[1:2] or [math.inf]
        score = 1 / sum(math.exp((best - s) / 2) for s in sizes)
        return self.languages[sizes.index(best)], score, rivals[0] - best < margin * best


def identify(docs: DataFrame, learned: dict[str, tuple[bytes, float]], margin: float = 0.01) -> DataFrame:
    """``docs`` with ``lang_pred, score, rejected`` added for every row (replaced if there).

    Only the whole text is read. ``score`` falls from 1 with the advantage in bytes over the other languages;
    ``rejected`` marks an advantage under ``margin`` of the size. Null texts, texts without a letter, and all
    texts when no language was learned are ``und`` with score 0. Ties go to the first language by name.
    """
    kept = docs.drop("lang_pred", "score", "rejected")
    shared = docs.sparkSession.sparkContext.broadcast(learned)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin("language")
        coders = Compressors(shared.value)
        for batch in batches:
            found = [coders.predict(x, margin) for x in batch.column("text").to_pylist()]
            kinds = pa.string(), pa.float64(), pa.bool_()
            columns = [pa.array([x[i] for x in found], kind) for i, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], [*batch.schema.names, "lang_pred", "score", "rejected"])

    return widened(kept, run, "lang_pred string, score double, rejected boolean")
