"""Toxicity by subword bags: character n-gram vectors averaged into a linear softmax, trained jointly.

A word's vector is the mean of the vectors of its hashed character n-grams and of itself, so a misspelling
that was never seen shares most of its vector with the words it resembles. A text has two features: the mean of
all its words' vectors (the averaged bag), and the mean over its worst run of a few words, because an average alone
hides two words among thousands. A linear softmax over both gives the probability. Embeddings and softmax are
trained together, in numpy: at first every word with its text's label, then whole texts by both features.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.sampling import draw_of, least_drawn
from millrace.llm.words import Cache, begin, widened
from millrace.session import materialise

BUCKETS = 1 << 18
GRAMS = (3, 4, 5, 6)
WORD = re.compile(r"\w+")


def words(text: str | None) -> list[str]:
    return WORD.findall(text.lower()) if text else []


def grams(word: str) -> list[int]:
    """Buckets of a word's n-grams, over its bytes between marks, and of the word itself."""
    marked = b"<" + word.encode() + b">"
    n = len(marked)
    return [zlib.crc32(marked[i : i + k]) % BUCKETS for k in GRAMS if k < n for i in range(n - k + 1)] + [zlib.crc32(marked) % BUCKETS]


class _Adam:
    """Adam over one array."""

    def __init__(self, value: np.ndarray, rate: float):
        self.value, self.rate, self.turn = value, rate, 0
        self.first, self.second = np.zeros_like(value), np.zeros_like(value)

    def step(self, gradient: np.ndarray) -> None:
        self.turn += 1
        self.first += 0.1 * (gradient - self.first)
        self.second += 0.01 * (gradient * gradient - self.second)
        self.value -= self.rate * (self.first / (1 - 0.9**self.turn)) / (np.sqrt(self.second / (1 - 0.99**self.turn)) + 1e-8)


def train(
    texts: list[str], labels: list[int], window: int = 3, size: int = 8, first: int = 20, rounds: int = 150, least_texts: int = 3, decay: float = 1e-6, seed: int = 1
) -> tuple[np.ndarray, float]:
    """Each bucket's contributions to the toxic class's logit margin, in the averaged bag and in a run, and the bias."""
    vocabulary: dict[str, int] = {}
    docs = [np.array([vocabulary.setdefault(w, len(vocabulary)) for w in words(t)], np.int64) for t in texts]
    y = np.array([bool(x) for x, d in zip(labels, docs, strict=True) if len(d)], np.float32)
    docs = [d for d in docs if len(d)]
    if not len(y) or y.min() == y.max():
        return np.zeros((2, BUCKETS), np.float32), float(len(y) and (8 if y[0] else -8))
    bags = [grams(w) for w in vocabulary]
    counts = np.array([len(b) for b in bags])
    flat = np.fromiter((g for b in bags for g in b), np.int64, counts.sum())
    used, flat = np.unique(flat, return_inverse=True)
    starts = np.r_[0, np.cumsum(counts)[:-1]]
    owner = np.repeat(np.arange(len(bags)), counts)

    rng = np.random.default_rng(seed)
    table = _Adam(rng.normal(0, 0.1, (len(used), size)).astype(np.float32), 0.02)
    softmax = _Adam(rng.normal(0, 0.1, (2, size, 2)).astype(np.float32), 0.02)
    bias = _Adam(np.zeros(2, np.float32), 0.02)

    weight = np.where(y > 0, 0.5 / y.sum(), 0.5 / (1 - y).sum())
    once = [np.unique(d) for d in docs]
    present, of = np.concatenate(once), np.repeat(np.arange(len(docs)), [len(d) for d in once])
    # a word of fewer texts cannot explain a toxic label; in clean texts every word counts
    trusted = np.bincount(present, minlength=len(bags)) >= least_texts
    counted = (trusted[present] | (y[of] == 0)).astype(np.float64)
    each = weight[of] * counted / np.maximum(1, np.bincount(of, counted, len(docs)))[of]
    share, toxic = (np.bincount(present, each * part, len(bags)) for part in (1.0, y[of]))

    sequence = np.concatenate(docs)
    lengths = np.array([len(d) for d in docs])
    ends, width = np.cumsum(lengths), np.minimum(lengths, window)
    doc = np.repeat(np.arange(len(docs)), lengths)
    begins = np.flatnonzero(np.arange(len(sequence)) + width[doc] <= ends[doc])
    begin_doc = doc[begins]
    begin_width, first_begin = width[begin_doc], np.searchsorted(begin_doc, np.arange(len(docs)))
    usable = trusted[sequence] | (y[doc] == 0)

    for turn in range(first + rounds):
        bag_of, margin_of = softmax.value[:, :, 1] - softmax.value[:, :, 0]
        offset = float(bias.value[1] - bias.value[0])
        margins = np.add.reduceat((table.value @ margin_of)[flat], starts) / counts
        in_bag = np.add.reduceat((table.value @ bag_of)[flat], starts) / counts
        bags_of_texts = np.add.reduceat(in_bag[sequence], ends - lengths) / lengths
        if turn < first:
            pull = share / (1 + np.exp(-(margins + offset))) - toxic
            bias_pull = pull.sum()
            error = weight * (1 / (1 + np.exp(-(bags_of_texts + offset))) - y)
        else:
            sums = np.r_[0.0, np.cumsum(np.where(usable, margins[sequence], 0.0))]
            runs = (sums[begins + begin_width] - sums[begins]) / begin_width
            top = np.maximum.reduceat(runs, first_begin)
            hits = np.flatnonzero(runs == top[begin_doc])
            best = begins[hits[np.unique(begin_doc[hits], return_index=True)[1]]]
            error = weight * (1 / (1 + np.exp(-(top + bags_of_texts + offset))) - y)
            inside = np.repeat(best, width) + np.arange(width.sum()) - np.repeat(np.cumsum(width) - width, width)
            pull = np.bincount(sequence[inside], np.repeat(error / width, width) * usable[inside], len(bags))
            bias_pull = error.sum()
        bag_pull = np.bincount(sequence, (error / lengths)[doc], len(bags))
        # all that a bucket's vector gets lies along the softmax's margins, so two numbers per bucket are summed
        on_bag, on_run = (np.bincount(flat, (x / counts)[owner], len(used)).astype(np.float32) for x in (bag_pull, pull))
        gradient = np.outer(on_bag, bag_of) + np.outer(on_run, margin_of) + decay * table.value
        softmax.step(np.stack([np.stack([-x @ table.value, x @ table.value], axis=1) for x in (on_bag, on_run)]) + decay * softmax.value)
        bias.step(np.array([-bias_pull, bias_pull], np.float32))
        table.step(gradient)
    out = np.zeros((2, BUCKETS), np.float32)
    out[:, used] = (softmax.value[:, :, 1] - softmax.value[:, :, 0]) @ table.value.T
    return out, float(bias.value[1] - bias.value[0])


def fit(docs: DataFrame, labels: DataFrame, sample: int = 1500, window: int = 3) -> tuple[bytes, float]:
    """Train on ``docs(doc_id, text)`` with ``labels(doc_id, toxic)``; returns the buckets' margins and the bias.

    The sample is bounded: of either label the ``sample`` rows with the least md5(doc_id), whole texts. It is
    trained in one task, so a lost executor only repeats it. Rows without label, doc_id or text teach nothing;
    a doc_id with two labels counts as toxic.
    """
    marked = labels.filter("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    drawn = materialise(marked.withColumn("draw", draw_of()), "toxic-labels")
    parts = [least_drawn(drawn.filter(f"toxic {test} 0"), "draw", ["draw", "doc_id"], sample).drop("draw") for test in ("<>", "=")]
    chosen = parts[0].union(parts[1])
    rows = docs.select("doc_id", "text").filter("text is not null").join(F.broadcast(chosen), "doc_id").select("doc_id", "text", "toxic")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = sorted((r["doc_id"], r["text"], r["toxic"]) for b in batches for r in b.to_pylist())
        margins, bias = train([x[1] for x in held], [x[2] for x in held], window)
        yield pa.RecordBatch.from_arrays([pa.array([margins.tobytes()], pa.binary()), pa.array([bias])], ["margins", "bias"])

    row = rows.repartition(1).mapInArrow(run, "margins binary, bias double").first()
    if row is None:
        return np.zeros((2, BUCKETS), np.float32).tobytes(), -8.0
    return bytes(row["margins"]), row["bias"]


def score(docs: DataFrame, model: tuple[bytes, float], window: int = 3) -> DataFrame:
    """``docs`` with ``score`` added for every row (replaced if there): the probability from its bag and worst run.

    Null texts and texts without words have score 0. Only the whole text is read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kept = docs.drop("score")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin("toxicity")
        margins, bias = np.frombuffer(shared.value[0], np.float32).reshape(2, BUCKETS).T, shared.value[1]

        def of_word(word: str) -> complex:
            in_bag, in_run = margins[grams(word)].mean(axis=0).tolist()
            return complex(in_bag, in_run)

        known = Cache(of_word)
        for batch in batches:
            known.trim()
            out = []
            for text in batch.column("text").to_pylist():
                found = words(text)
                if not found:
                    out.append(0.0)
                    continue
                values = np.fromiter(map(known.__getitem__, found), np.complex128, len(found))
                sums, width = np.cumsum(values.imag), min(window, len(found))
                runs = (sums[width - 1 :] - np.r_[0.0, sums[:-width]]) / width
                out.append(float(1 / (1 + np.exp(-np.clip(values.real.mean() + runs.max() + bias, -30, 30)))))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.float64())], [*batch.schema.names, "score"])

    return widened(kept, run, "score double")
