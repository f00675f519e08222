"""Whole results where a shorter one went unseen: survivors of the pipeline's groups, spellings of random strings."""

import gc
import tracemalloc

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from millrace.llm import automaton, secret_scan
from millrace.llm.queries import word_tokenizer

ROWS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def line(name, n=40):
    return " ".join(f"{name}{i}" for i in range(n))


def test_near_duplicates_keeps_one_row_of_every_group(spark):
    a, b, c, d, e = (line(x) for x in "abcde")
    rows = [
        (1, b, "en", "s", 1), (None, b + " end", "en", "s", 1),  # a kin of a row with an id goes
        (None, a, "en", "s", 1), (None, a, "en", "s", 1), (None, a + " end", "en", "s", 1), (None, c, "en", "s", 1), (None, "of its own", "en", "s", 1),
        (2, d, "en", "s", 1), (5, d + " end", "en", "s", 1), (5, e, "en", "s", 1),  # of id 5 the copy goes and the clean text stays
        (6, "first text under six", "en", "s", 1), (6, "second text under six", "en", "s", 1), (7, "twice", "en", "s", 1), (7, "twice", "de", None, 1),
        (8, None, "en", "s", 0), (8, "something", "en", "s", 1), (None, " ", "en", "s", 1), (None, "", "en", "s", 0), (9, "", None, None, None),
    ]
    out = corpus_pipeline.near_duplicates(spark, spark.createDataFrame(rows, ROWS).repartition(3), "")
    got = sorted(((r["doc_id"], r["text"]) for r in out.collect()), key=repr)
    of_a = [x for x in got if x[0] is None and x[1] in (a, a + " end")]
    assert len(of_a) == 1
    assert sorted((x for x in got if x not in of_a), key=repr) == sorted(
        [(1, b), (None, c), (None, "of its own"), (2, d), (5, e), (6, "first text under six"), (6, "second text under six"), (7, "twice"), (8, None), (8, "something"), (None, " "), (None, ""), (9, "")],
        key=repr,
    )


def test_secret_models_find_upper_and_lower_spellings(spark):
    rng = np.random.default_rng(11)
    alphabets = {"upper": "0123456789ABCDEF", "lower": "abcdefghijklmnopqrstuvwxyz0123456789"}
    rows = [(kind, "".join(rng.choice(list(chars), 20))) for kind, chars in alphabets.items() for _ in range(200)]
    rows += [("plain", w) for w in ("identifiers_everywhere", "ordinaryIdentifiersInTexts", "settings/default-values")]
    ratios = secret_scan.fit(secret_scan.labelled_samples(spark.read.parquet("/root/testdata/sf0.001/documents.parquet")))
    found = secret_scan.secret_spans(spark.createDataFrame(rows, "kind string, text string"), ratios)
    got = {r["kind"]: r["share"] for r in found.groupBy("kind").agg(F.avg((F.size("spans") > 0).cast("int")).alias("share")).collect()}
    assert got["upper"] >= 0.95 and got["lower"] >= 0.95 and got["plain"] == 0


def test_pieces_kept_by_the_automaton_take_little_memory():
    machine = automaton.WordTokenizer(open(word_tokenizer(), encoding="utf-8").read())
    gc.collect()
    before = pa.total_allocated_bytes()
    tracemalloc.start()
    try:
        for part in range(10):
            machine.encode(" ".join([f"ab{part}x{n}" for n in range(6000)]))
        machine.encode(" ".join([str(n) + "abcdefgh" * 2500 for n in range(40)]))
        gc.collect()
        kept = tracemalloc.get_traced_memory()[0] + pa.total_allocated_bytes() - before
    finally:
        tracemalloc.stop()
    assert kept < 10 << 20


def test_automaton_is_right_for_pieces_let_go_and_seen_again():
    tokenizer, rng = Tokenizer.from_file(word_tokenizer()), np.random.default_rng(4)
    machine = automaton.WordTokenizer(open(word_tokenizer(), encoding="utf-8").read())
    machine._of_chunk.entries = machine._of_word.entries = 20
    pieces = ["".join(rng.choice(list("aeilnst,É中"), rng.integers(0, 9))) for _ in range(300)] + ["long" * 40, "<s>", "Σ"]
    for _ in range(30):
        texts = [" ".join(rng.choice(pieces, 12)) for _ in range(4)] + [None, ""]
        ids, ends = machine.encode_all(pa.array(texts, pa.string()))
        assert [ids[a:b].tolist() for a, b in zip(ends[:-1], ends[1:], strict=True)] == [tokenizer.encode(x or "", add_special_tokens=False).ids for x in texts]
        assert len(machine._of_chunk.pieces) == len(machine._of_chunk.used) <= 30
