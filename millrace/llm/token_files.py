"""Token-id files: Arrow streams of equal-length sequences with masks.

A table of documents is encoded and written as shards in ascending doc_id order. A shard has two files:

- ``tokens-<number>.arrows``: an Arrow IPC stream without compression whose batches hold the columns
  ``tokens`` (fixed-size list of unsigned integers, 16 bits when the vocabulary allows) and ``mask``
  (fixed-size list of booleans, false for padding). All documents of the shard stand one after the other,
  each with its end id; only the last sequence is padded. Every batch but the last has the same number of
  sequences, so sequence ``i`` is found without an index and read as a view of the mapped file.
- ``docs-<number>.arrows``: doc_id, start and n_tokens of each document in the shard.

A manifest table lists the shards. Files are written under a temporary name and then moved, and a rerun
of a task writes the same bytes, so a lost executor leaves nothing half done.
"""

from __future__ import annotations

import json
import os
import string
import unicodedata
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from millrace.llm.ranges import with_ranges
from millrace.llm.words import begin, keep_until_other
from millrace.session import materialise

#: Sequences in a batch of a token file.
BATCH = 64

_MANIFEST = "part int, first_id bigint, tokens_file string, docs_file string, n_docs bigint, n_tokens bigint"
_MANIFEST_ARROW = pa.schema(
    [("part", pa.int32()), ("first_id", pa.int64()), ("tokens_file", pa.string()), ("docs_file", pa.string()), ("n_docs", pa.int64()), ("n_tokens", pa.int64())]
)
_INDEX = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64())])
_READ_ARROW = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary())])


def chunks(text: str) -> list[str]:
    """Pieces between spaces and line ends, which no token of a white-space-dropping vocabulary spans."""
    return text.replace("\n", " ").split(" ")


def joined(texts: list[str], values: Callable[[list[str]], list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """The values of every text's chunks one after the other, as bytes, and where each text begins and ends.

    ``values`` is asked once for the distinct chunks of the texts.
    """
    split = pc.split_pattern(pa.array([x.replace("\n", " ") for x in texts], pa.large_string()), " ")
    coded = split.flatten().dictionary_encode()
    taken = pa.array(values(coded.dictionary.to_pylist()), pa.large_binary()).take(coded.indices)
    _, offsets, data = taken.buffers()
    places = np.frombuffer(offsets, np.int64)[: len(taken) + 1]
    return np.frombuffer(data, np.uint8) if data else np.empty(0, np.uint8), places[split.offsets.to_numpy()]


def slices(texts: list[str | None], chars: int) -> list[tuple[int, int]]:
    """Ranges of texts of about so many characters together; a longer text has a range of its own."""
    total = np.cumsum([len(x or "") for x in texts])
    cuts = [0, *(np.flatnonzero(np.diff(total // chars)) + 1).tolist(), len(texts)] if texts else [0]
    return [(a, b) for a, b in zip(cuts[:-1], cuts[1:], strict=True) if a < b]


def plain_tokenizer(content: str) -> Tokenizer:
    tokenizer = Tokenizer.from_str(content)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def id_type(tokenizer: Tokenizer, end_id: int | None = None) -> np.dtype:
    return np.dtype("<u2") if max(tokenizer.get_vocab_size(), end_id or 0) <= 1 << 16 else np.dtype("<u4")


class ChunkEncoder:
    """Ids of whole texts from the tokenizer's ids of their chunks, which are kept for the chunks to come.

    A chunk of letters and closing ASCII punctuation is two words to the vocabulary's pattern, so its ids are
    those of the lower-case letters and those of the punctuation. New runs of letters go through the
    tokenizer's byte level and merges together; each one's ids end with the one token that closes a word.
    Other new chunks are encoded together with a special token between each two, where the tokenizer
    splits a text before anything else, so each gets the ids that it has alone. Both ways end in the
    same model; vocabularies without word ends or with another normaliser only take the second.
    """

    def __init__(self, content: str, end_id: int, entries: int = 1_000_000, lump: int = 20_000):
        self.tokenizer = plain_tokenizer(content)
        self.kind = id_type(self.tokenizer, end_id)
        self.end = np.array([end_id], self.kind).tobytes()
        self.known: dict[str, bytes] = {}
        self.entries, self.lump = entries, lump
        added = self.tokenizer.get_added_tokens_decoder()
        self.specials = [t.content for t in added.values()]
        plain = ((i, t.content) for i, t in added.items() if not (t.normalized or t.lstrip or t.rstrip or t.single_word))
        self.mark, self.between = next(plain, (None, None))
        spec = json.loads(content)
        steps = [x["type"] for x in (spec["normalizer"] or {}).get("normalizers", [])]
        suffix = spec["model"].get("end_of_word_suffix")
        self.merges = None
        if suffix and steps == ["NFC", "Replace", "Lowercase"] and not any(s.rstrip(string.punctuation).isalpha() for s in self.specials):
            spec["normalizer"], spec["added_tokens"] = None, []
            byte_level = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}
            spec["pre_tokenizer"] = {"type": "Sequence", "pretokenizers": [{"type": "WhitespaceSplit"}, byte_level]}
            self.merges = plain_tokenizer(json.dumps(spec))
            self.closes = np.zeros(max(spec["model"]["vocab"].values()) + 1, bool)
            self.closes[[i for token, i in spec["model"]["vocab"].items() if token.endswith(suffix)]] = True

    def _ids(self, text: str, tokenizer: Tokenizer) -> np.ndarray:
        return np.array(tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, self.kind)

    def _cut(self, into: dict[str, bytes], some: list[str], ids: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> None:
        data, size = ids.tobytes(), self.kind.itemsize
        for chunk, a, b in zip(some, (begins * size).tolist(), (ends * size).tolist(), strict=True):
            into[chunk] = data[a:b]

    def _learn_letters(self, new: list[str]) -> None:
        for at in range(0, len(new), self.lump):
            some = new[at : at + self.lump]
            ids = self._ids(" ".join(some), self.merges)
            ends = np.flatnonzero(self.closes[ids]) + 1
            self._cut(self.known, some, ids, np.r_[0, ends[:-1]], ends)

    def _learn_any(self, new: list[str]) -> None:
        apart = new if self.mark is None else [c for c in new if any(s in c for s in self.specials)]
        for chunk in apart:
            self.known[chunk] = self._ids(chunk, self.tokenizer).tobytes()
        marked = set(apart)
        together = [c for c in new if c not in marked]
        for at in range(0, len(together), self.lump):
            some = together[at : at + self.lump]
            ids = self._ids(self.between.join(some), self.tokenizer)
            cuts = np.flatnonzero(ids == self.mark)
            self._cut(self.known, some, ids, np.r_[0, cuts + 1], np.r_[cuts, len(ids)])

    def _learn(self, new: set[str]) -> None:
        if self.merges is None:
            self._learn_any(list(new))
            return
        pairs, others, letters = [], set(), set()
        for chunk in new:
            if chunk.isascii() and chunk.isalpha() and chunk.islower():
                letters.add(chunk)
                continue
            head = chunk.rstrip(string.punctuation)
            low = head.lower()
            # letters whose lower case is letters too, and which no normal form changes
            if low.isalpha() and head.isalpha() and (head.isascii() or "Σ" not in head and unicodedata.is_normalized("NFC", head)):
                letters.add(low)
                tail = chunk[len(head) :]
                if chunk != low:
                    pairs.append((chunk, low, tail))
                if tail:
                    others.add(tail)
            else:
                others.add(chunk)
        self._learn_any(list(others.difference(self.known)))
        self._learn_letters(list(letters.difference(self.known)))
        for chunk, low, tail in pairs:
            self.known[chunk] = self.known[low] + self.known[tail] if tail else self.known[low]

    def _plain(self, text: str | None) -> str:
        """The text in lower case where that cannot change its ids: Latin text without a special token."""
        if not text or self.merges is None:
            return text or ""
        low = text.lower()
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return text
        return text if any(s in low for s in self.specials) else low

    def _values(self, some: list[str]) -> list[bytes]:
        found = list(map(self.known.get, some))
        if None in found:
            self._learn({chunk for chunk, ids in zip(some, found, strict=True) if ids is None})
            found = list(map(self.known.__getitem__, some))
        return found

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text and the end id."""
        if len(self.known) > self.entries:
            self.known.clear()
        data, places = joined([self._plain(x) for x in texts], self._values)
        data = data.tobytes()
        return [data[a:b] + self.end for a, b in zip(places[:-1].tolist(), places[1:].tolist(), strict=True)]


_CODERS: dict[tuple[int, int], ChunkEncoder] = {}
keep_until_other(_CODERS.clear)


def _coder(content, end_id: int) -> ChunkEncoder:
    """One encoder for each process and file, so that a task knows the chunks of the tasks before it."""
    key = hash(content.value), end_id
    if key not in _CODERS:
        _CODERS.clear()
        _CODERS[key] = ChunkEncoder(content.value, end_id)
    return _CODERS[key]


def _encode(content, end_id: int, chars: int = 16_000_000):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin("token files")
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the tasks are the parallel part
        coder = _coder(content, end_id)
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for a, b in slices(texts, chars):
                part = batch.slice(a, b - a)
                ids = pa.array(coder.encode(texts[a:b]), pa.binary())
                yield pa.RecordBatch.from_arrays([*[part.column(c) for c in ("part", "doc_id", "turn")], ids], ["part", "doc_id", "turn", "ids"])

    return run


class _Shard:
    """Writes one pair of files as documents arrive."""

    def __init__(self, folder: str, number: int, first, kind: np.dtype, length: int):
        self.fs, self.root = pafs.FileSystem.from_uri(folder)
        self.name = f"{number:010d}"
        self.number, self.first, self.kind, self.length = number, first, kind, length
        self.part = uuid.uuid4().hex
        self.list_type = pa.list_(pa.from_numpy_dtype(kind), length)
        self.mask_type = pa.list_(pa.bool_(), length)
        self.schema = pa.schema([("tokens", self.list_type), ("mask", self.mask_type)])
        self.file = self.fs.open_output_stream(self._path("tokens", True))
        self.writer = pa.ipc.new_stream(self.file, self.schema)
        self.index: list[tuple] = []
        self.waiting: list[bytes] = []
        self.held = self.n_tokens = 0

    def _path(self, what: str, partial: bool) -> str:
        return f"{self.root}/{what}-{self.name}.arrows" + f".{self.part}" * partial

    def add(self, doc_id, ids: bytes) -> None:
        count = len(ids) // self.kind.itemsize
        self.index.append((doc_id, self.n_tokens, count))
        self.n_tokens += count
        self.waiting.append(ids)
        self.held += count
        if self.held >= BATCH * self.length:
            self._flush(False)

    def _flush(self, last: bool) -> None:
        tokens = np.frombuffer(b"".join(self.waiting), self.kind)
        step = BATCH * self.length
        whole = len(tokens) // step * step
        for at in range(0, len(tokens) if last else whole, step):
            piece = tokens[at : at + step]
            padded = np.zeros(-(-len(piece) // self.length) * self.length, self.kind)
            padded[: len(piece)] = piece
            arrays = [
                pa.FixedSizeListArray.from_arrays(pa.array(padded), type=self.list_type),
                pa.FixedSizeListArray.from_arrays(pa.array(np.arange(len(padded)) < len(piece)), type=self.mask_type),
            ]
            self.writer.write_batch(pa.RecordBatch.from_arrays(arrays, schema=self.schema))
        rest = tokens[len(tokens) if last else whole :]
        self.waiting, self.held = [rest.tobytes()], len(rest)

    def close(self) -> tuple:
        self._flush(True)
        self.writer.close()
        self.file.close()
        with self.fs.open_output_stream(self._path("docs", True)) as out, pa.ipc.new_stream(out, _INDEX) as writer:
            columns = zip(*self.index, strict=True)
            writer.write_batch(pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], schema=_INDEX))
        for what in ("docs", "tokens"):
            self.fs.move(self._path(what, True), self._path(what, False))
        return self.number, self.first, self._path("tokens", False), self._path("docs", False), len(self.index), self.n_tokens


def _write(folder: str, kind: str, length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = None
        for batch in batches:
            for number, doc_id, ids in zip(*(batch.column(c).to_pylist() for c in ("part", "doc_id", "ids")), strict=True):
                shard = shard or _Shard(folder, number, doc_id, np.dtype(kind), length)
                shard.add(doc_id, ids)
        if shard:
            yield pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip(shard.close(), _MANIFEST_ARROW, strict=True)], schema=_MANIFEST_ARROW)

    return run


def write_token_files(docs: DataFrame, tokenizer: str, folder: str, length: int = 2048, end_id: int = 2) -> DataFrame:
    """Encode ``docs(doc_id, text)`` with the tokenizer file and write shards; returns the manifest.

    Documents stand in ascending doc_id order, a missing doc_id first, repeated ids by a hash of their text.
    A null or empty text is its end id alone. An empty table writes nothing and gives an empty manifest.
    Other columns of ``docs`` are not read. A range of ids is one shard (one id that many rows share, or lack, is
    several), so a task holds one batch of
    sequences and the shard's index. ``folder`` must be one that all executors reach.
    """
    spark = docs.sparkSession
    with open(tokenizer, encoding="utf-8") as file:
        content = file.read()
    kind = id_type(plain_tokenizer(content), end_id).str
    pafs.FileSystem.from_uri(folder)[0].create_dir(pafs.FileSystem.from_uri(folder)[1])
    shared = spark.sparkContext.broadcast(content)
    ranged, parts = with_ranges(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text"))
    encoded = ranged.select("part", "doc_id", "turn", "text").mapInArrow(_encode(shared, end_id), "part int, doc_id bigint, turn double, ids binary")
    ordered = encoded.repartitionById(parts, F.col("part")).sortWithinPartitions("doc_id", "turn", "ids").select("part", "doc_id", "ids")
    return materialise(ordered.mapInArrow(_write(folder, kind, length), _MANIFEST), "manifest")


class TokenFile:
    """Random access to the sequences of one token file; the arrays are views of the mapped file."""

    def __init__(self, path: str, fs: pafs.FileSystem | None = None):
        if fs is None or isinstance(fs, pafs.LocalFileSystem):
            self.source = pa.memory_map(path)
        else:
            self.source = fs.open_input_file(path)
        self.batches = list(pa.ipc.open_stream(self.source))

    def __len__(self) -> int:
        return sum(b.num_rows for b in self.batches)

    def __getitem__(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        """Tokens and mask of sequence ``i``."""
        batch = self.batches[i // BATCH]
        tokens, mask = batch.column(0), batch.column(1)
        length, at = tokens.type.list_size, i % BATCH
        row = slice(at * length, (at + 1) * length)
        return tokens.flatten().to_numpy()[row], mask.flatten().slice(at * length, length).to_numpy(zero_copy_only=False)


def _read(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, _ = pafs.FileSystem.from_uri(folder)
        for row in (r for b in batches for r in b.to_pylist()):
            with fs.open_input_stream(row["docs_file"]) as source:
                index = pa.ipc.open_stream(source).read_all()
            doc_ids, starts, counts = (index.column(c).to_pylist() for c in ("doc_id", "start", "n_tokens"))
            done, begin, held = 0, 0, np.empty(0, np.uint32)
            with fs.open_input_stream(row["tokens_file"]) as source:
                for batch in pa.ipc.open_stream(source):
                    tokens = batch.column(0).flatten().to_numpy()[batch.column(1).flatten().to_numpy(zero_copy_only=False)]
                    held = np.concatenate([held, tokens.astype("<u4")])
                    out = []
                    while done < len(doc_ids) and starts[done] + counts[done] <= begin + len(held):
                        at = starts[done] - begin
                        out.append((doc_ids[done], row["base"] + starts[done], counts[done], held[at : at + counts[done]].tobytes()))
                        done += 1
                    if out:
                        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), _READ_ARROW, strict=True)], schema=_READ_ARROW)
                    keep = (starts[done] if done < len(doc_ids) else begin + len(held)) - begin
                    held, begin = held[keep:], begin + keep
            if done < len(doc_ids):
                raise ValueError(f"{row['tokens_file']} ends before document {doc_ids[done]}")

    return run


def read_token_files(manifest: DataFrame, folder: str) -> DataFrame:
    """``(doc_id, start, n_tokens, ids)`` of every document in the files of a manifest.

    ``start`` counts the tokens of all documents before it and ``ids`` is little-endian unsigned 32-bit.
    A file is one task, read batch by batch. The running sum is over one row per file.
    """
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    based = manifest.withColumn("base", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))
    number = F.row_number().over(Window.orderBy("part")) - 1
    files = max(1, manifest.count())
    dealt = based.withColumn("task", number.cast("int")).repartitionById(files, F.col("task"))
    return dealt.mapInArrow(_read(folder), "doc_id bigint, start bigint, n_tokens bigint, ids binary")


def read_sequences(spark: SparkSession, manifest: DataFrame, folder: str) -> DataFrame:
    """``(tokens_file, sequence, tokens, mask)``: the equal-length rows as a training loop would see them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, _ = pafs.FileSystem.from_uri(folder)
        for row in (r for b in batches for r in b.to_pylist()):
            at = 0
            with fs.open_input_stream(row["tokens_file"]) as source:
                for batch in pa.ipc.open_stream(source):
                    n = batch.num_rows
                    tokens = batch.column(0).cast(pa.list_(pa.int64()))
                    names = pa.array([row["tokens_file"]] * n)
                    yield pa.RecordBatch.from_arrays(
                        [names, pa.array(range(at, at + n), pa.int64()), tokens, batch.column(1).cast(pa.list_(pa.bool_()))],
                        ["tokens_file", "sequence", "tokens", "mask"],
                    )
                    at += n

    files = manifest.select("tokens_file").repartition(max(1, manifest.count()), "tokens_file")
    return files.mapInArrow(run, "tokens_file string, sequence bigint, tokens array<bigint>, mask array<boolean>")
