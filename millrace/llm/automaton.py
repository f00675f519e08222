"""BPE tokenization automaton: merges compiled to a deterministic automaton over tokens.

The automaton starts with one state that every base symbol loops on. The gadget of merge ``u v -> w`` takes
the state that ``u`` leads to, gives ``u`` a copy of it without the arc ``v``, and lets ``w`` lead where
``v`` leads. All arcs of one label lead to the same state at any time, so a state is known by its label and
the number of gadgets built so far, and a copy is kept as its one missing arc: the copies of a label share
everything else with the state that its right part led to when the label was born. After all gadgets, every
string of base symbols is spelled by exactly one path, which is its tokenization.

Encoding walks a word's symbols and keeps, for each prefix, the last arc of its only path; the arc that
ends at a place is the one token whose arc leaves the state of the place where it begins.
"""

from __future__ import annotations

import json
import unicodedata
from array import array
from collections.abc import Callable, Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.bytewords import slices_of
from millrace.llm.words import Cache, LastingCache, keep_until_other, serving, widened

#: Pieces whose ids a process keeps, those used last; before they are sorted out there may be half as many more.
KEPT = 300_000

#: Words of pieces whose ids a process keeps in each of two generations.
KEPT_WORDS = 20_000

#: Longer pieces and words are encoded each time: texts without spaces are pieces of any length.
KEPT_CHARS = 64

#: White space of the vocabulary's patterns (the Unicode property, spelled out).
SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = {*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(0x100, 0x200))
    return [chr(b) if b in plain else chr(next(others)) for b in range(256)]


def _without_ends(table: dict) -> None:
    """Put the token itself in place of every nested table that holds nothing else: most do, and each takes 184 bytes."""
    for symbol, nested in table.items():
        if nested.__class__ is dict:
            if len(nested) == 1 and "" in nested:
                table[symbol] = nested[""]
            else:
                _without_ends(nested)


class MergeAutomaton:
    """The states and arcs of a vocabulary's merges."""

    def __init__(self, vocabulary: dict[str, int], merges: list[tuple[str, str]], end: str = ""):
        self.vocabulary = vocabulary
        self.end = end
        self.size = max(vocabulary.values(), default=0) + 1
        #: by token: number of the gadget that made it, and its parts; base symbols are there from the start and have -1
        self.born, self.first, self.last = (array("i", [-1]) * self.size for _ in range(3))
        #: label * size + missing arc -> number of the gadget that took the arc away
        self.cut: dict[int, int] = {}
        self.states = 1
        for number, (left, right) in enumerate(merges):
            self._gadget(number, vocabulary[left], vocabulary[right], vocabulary[left + right])
        self.gadgets = len(merges)
        #: arcs looked up so far, by label
        self._arcs = Cache(lambda label: {}, len(vocabulary))
        self._asked = 0
        #: tokens that some path uses, spelled backwards, as nested tables; the token itself stands under "", or alone where nothing follows
        self._inner: dict = {}
        self._final: dict = {}
        for token, number in vocabulary.items():
            closing = bool(end) and token.endswith(end)
            spelled = token[: -len(end)] if closing else token
            if self.born[number] < 0 and len(spelled) > 1:
                continue
            for table in [self._final] if closing else [self._inner] if end else [self._inner, self._final]:
                for symbol in reversed(spelled):
                    table = table.setdefault(symbol, {})
                table[""] = number
        for table in (self._inner, self._final):
            _without_ends(table)

    def _gadget(self, number: int, u: int, v: int, w: int) -> None:
        if self.born[w] >= 0 or not self._has_arc(u, v, number):
            return  # no path has u before v any more: the merge never applies
        self.born[w], self.first[w], self.last[w] = number, u, v
        self.cut[u * self.size + v] = number
        self.states += 1

    def _has_arc(self, label: int, arc: int, now: int) -> bool:
        """Whether the state that ``label`` leads to after ``now`` gadgets has the arc.

        The state's missing arcs are those cut from ``label`` itself, and those cut from its right parts
        before they passed their state on. An arc is there if at its birth its left part was, and so on; a
        gadget of two equal parts cuts before it adds.
        """
        while label >= 0:
            part, until = arc, now
            while part >= 0:
                cut = self.cut.get(label * self.size + part)
                if cut is not None and cut < now and (part == arc or cut <= until):
                    return False
                until = self.born[part]
                part = self.first[part]
            now, label = min(now, self.born[label]), self.last[label]
        return True

    def _leads(self, label: int, arc: int) -> bool:
        row = self._arcs[label]
        if arc not in row:
            row[arc] = self._has_arc(label, arc, self.gadgets)
            self._asked += 1
        return row[arc]

    def encode(self, symbols: str) -> list[int]:
        """Token ids of a word given as byte symbols."""
        n = len(symbols)
        last: list = [None] * (n + 1)
        begins = [0] * (n + 1)
        arcs = self._arcs
        for stop in range(1, n + 1):
            table = self._inner if stop < n else self._final
            ending, start = [], stop
            while start:
                start -= 1
                table = table.get(symbols[start])
                if table is None:
                    break
                if table.__class__ is int:
                    if not start or last[start] is not None:
                        ending.append((start, table))
                    break
                token = table.get("")
                if token is not None and (not start or last[start] is not None):
                    ending.append((start, token))
            while ending:
                start, token = ending.pop()
                known = arcs[last[start]].get(token) if start else True
                if known or known is None and self._leads(last[start], token):
                    last[stop], begins[stop] = token, start
                    break
        if self._asked > 250_000:
            arcs.clear()
            self._asked = 0
        out, at = [], n
        while at:
            if last[at] is None:  # a base symbol that the vocabulary lacks is left out
                at -= 1
                continue
            out.append(last[at])
            at = begins[at]
        return out[::-1]


class KeptCodes:
    """Codes of the pieces used last, in Arrow columns: a small part of the memory that a dict of them takes."""

    def __init__(self, make: Callable[[str], bytes], entries: int, chars: int = KEPT_CHARS):
        self.make, self.entries, self.chars = make, entries, chars
        self.clear()

    def clear(self) -> None:
        self.pieces, self.codes = pa.array([], pa.large_string()), pa.array([], pa.large_binary())
        #: number of the call that used each piece last
        self.used, self.calls = np.empty(0, np.int64), 0

    def of(self, pieces: pa.Array) -> pa.Array:
        """The code of each of some distinct pieces."""
        self.calls += 1
        held = pc.index_in(pieces, value_set=self.pieces)
        new = pieces.filter(held.is_null())
        made = pa.array(map(self.make, new.to_pylist()), pa.large_binary(), size=len(new))
        at = held.fill_null(-1).to_numpy().astype(np.int64)
        old = at >= 0
        self.used[at[old]] = self.calls
        at[~old] = len(self.pieces) + np.arange(len(new))
        found = pa.concat_arrays([self.codes, made])
        short = pc.less_equal(pc.utf8_length(new), self.chars)
        self._keep(new.filter(short), made.filter(short))
        return found.take(pa.array(at))

    def _keep(self, pieces: pa.Array, codes: pa.Array) -> None:
        self.pieces, self.codes = pa.concat_arrays([self.pieces, pieces]), pa.concat_arrays([self.codes, codes])
        self.used = np.r_[self.used, np.full(len(pieces), self.calls)]
        if len(self.used) > self.entries * 3 // 2:
            last = pa.array(np.sort(np.argpartition(self.used, -self.entries)[-self.entries :]))
            self.pieces, self.codes, self.used = self.pieces.take(last), self.codes.take(last), self.used[last.to_numpy()]


class WordTokenizer:
    """Encoder and decoder of a word-end BPE file: normalise, split, and run the automaton on each word."""

    def __init__(self, content: str):
        spec = json.loads(content)
        model = spec["model"]
        vocabulary = model["vocab"]
        merges = [tuple(m.split(" ") if isinstance(m, str) else m) for m in model["merges"]]
        self.automaton = MergeAutomaton(vocabulary, merges, model["end_of_word_suffix"] or "")
        self.labels = {i: token for token, i in vocabulary.items()}
        self.added = {x["content"]: x["id"] for x in spec["added_tokens"]}
        self.labels.update({i: token for token, i in self.added.items()})
        pattern = next(x["pattern"]["Regex"] for x in spec["pre_tokenizer"]["pretokenizers"] if x["type"] == "Split")
        self.words = regex.compile(pattern.replace(r"\s", SPACE))
        self.specials = regex.compile("|".join(map(regex.escape, sorted(self.added, key=len, reverse=True))) or r"(?!)")
        self.marked = all("<" in x for x in self.added)
        self.symbols = byte_symbols()
        self._of_word = LastingCache(self._encode_word, KEPT_WORDS)
        self._of_chunk = KeptCodes(self._encode_chunk, KEPT)

    def _encode_word(self, word: str) -> bytes:
        return array("I", self.automaton.encode("".join([self.symbols[b] for b in word.encode()]))).tobytes()

    def _word(self, word: str) -> bytes:
        return self._of_word[word] if len(word) <= KEPT_CHARS else self._encode_word(word)

    def _encode_piece(self, text: str) -> bytes:
        if text.isascii():
            text = text.lower()
            if text.isalpha():
                return self._word(text)
        else:
            text = unicodedata.normalize("NFC", text)
            text = text.lower() if "Σ" not in text else "".join([c.lower() for c in text])
        return b"".join([self._word(word) for word in self.words.findall(text)])

    def _encode_chunk(self, chunk: str) -> bytes:
        self._of_word.trim()
        if "<" not in chunk and self.marked:
            return self._encode_piece(chunk)
        ids, at = [], 0
        for found in self.specials.finditer(chunk):
            ids.append(self._encode_piece(chunk[at : found.start()]))
            ids.append(self.added[found[0]].to_bytes(4, "little"))
            at = found.end()
        return b"".join(ids) + self._encode_piece(chunk[at:])

    def encode(self, text: str) -> np.ndarray:
        return self.encode_all(pa.array([text], pa.large_string()))[0]

    def encode_all(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Token ids of all texts one after the other, and where each text begins and ends; null texts have none.

        The distinct pieces between spaces and line ends are encoded once: no token spans them.
        """
        split = pc.split_pattern(pc.replace_substring(texts.cast(pa.large_string()).fill_null(""), "\n", " "), " ")
        pieces = split.flatten().dictionary_encode()
        taken = self._of_chunk.of(pieces.dictionary).take(pieces.indices)
        _, offsets, data = taken.buffers()
        places = np.frombuffer(offsets, np.int64)[: len(taken) + 1][split.offsets.to_numpy()]
        return np.frombuffer(data, "<u4") if data else np.empty(0, "<u4"), places // 4

    def decode(self, ids: np.ndarray) -> str:
        """Labels of the arcs in order, as the file's missing decoder joins them; unknown ids emit nothing."""
        try:
            return " ".join(map(self.labels.__getitem__, ids.tolist()))
        except KeyError:
            return " ".join([self.labels[i] for i in ids.tolist() if i in self.labels])


_TOKENIZERS: dict[int, WordTokenizer] = {}
keep_until_other(_TOKENIZERS.clear)


def _tokenizer(content) -> WordTokenizer:
    """One compiled tokenizer for each process and file."""
    key = hash(content.value)
    if key not in _TOKENIZERS:
        _TOKENIZERS.clear()
        _TOKENIZERS[key] = WordTokenizer(content.value)
    return _TOKENIZERS[key]


def encode_and_decode(docs: DataFrame, tokenizer: str, slice_bytes: int = 1 << 20) -> DataFrame:
    """``docs`` with ``ids array<int>`` and ``decoded string`` added, for every row.

    Null and empty texts have no ids and decode to the empty text. Columns of ``docs`` named ``ids`` or
    ``decoded`` are replaced; all others pass unchanged. Words repeat, so a process keeps the ids of the
    pieces it has seen lately; the kept pieces are bounded in number and length. ``slice_bytes`` bounds the text
    that a task has encoded at a time.
    """
    with open(tokenizer, encoding="utf-8") as file:
        shared = docs.sparkSession.sparkContext.broadcast(file.read())
    kept = docs.drop("ids", "decoded")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _tokenizer(shared)
        for batch in batches:
            for part in slices_of(batch, "text", slice_bytes):
                ids, ends = coder.encode_all(part.column("text"))
                lists = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(ids.astype(np.int32)))
                decoded = [coder.decode(ids[a:b]) for a, b in pairwise(ends.tolist())]
                columns = [*part.columns, lists, pa.array(decoded, pa.string())]
                yield pa.RecordBatch.from_arrays(columns, [*part.schema.names, "ids", "decoded"])
                pa.default_memory_pool().release_unused()

    return widened(kept, serving("automaton", run), "ids array<int>, decoded string")


def joined_ids(ids: str = "ids"):
    """Decimal ids separated by one space."""
    return F.concat_ws(" ", F.col(ids).cast("array<string>"))
