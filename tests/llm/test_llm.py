"""Operators for training-data pipelines on small fixtures, against brute force, round trips or held-out rows."""

import hashlib
import itertools
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from millrace.llm import automaton, components, fingerprints, html_layout, language, mixing, ngram_join, repetition, secret_scan, token_files, toxicity
from millrace.llm.queries import word_tokenizer

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("source", T.StringType())])
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LONG = " ".join(f"word{i % 977}x{i}" for i in range(6000))
BASE = " ".join(f"w{i}" for i in range(60))
ROWS = [
    (7, None, "a"), (3, "", "a"), (5, " \n\t ", None), (1, BASE, "a"), (2, BASE.replace("w30", "other"), "b"), (4, BASE.upper(), "b"), (8, "one two", None), (9, "One Two", "c"),
    (10, LONG, "a"), (11, LONG + " tail", "a"), (12, "a a a a a a a a a a a a", "c"), (12, "a a a a a a a a a a a a", "c"), (13, "xﬁ <|endoftext|> İ Σ é", "c"),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, DOCS).withColumn("n", F.lit("clash")).withColumn("size", F.lit(1)).withColumn("part", F.lit("x"))


def words_of(text):
    return WORD.findall(text or "")


def shingles(text):
    w = words_of("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def test_ngram_join_matches_all_pairs(spark, docs):
    sets = {i: shingles(t) for i, t, _ in ROWS}
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in itertools.combinations(sets, 2):
        both = len(sets[a] & sets[b])
        if sets[a] and sets[b] and 100 * both >= 75 * len(sets[a] | sets[b]):
            x, y = root(a), root(b)
            parent[max(x, y)] = min(x, y)
    got = sorted(tuple(r) for r in ngram_join.ngram_join(docs, cell=2).collect())
    assert got == sorted((i, len(shingles(t)), root(i)) for i, t, _ in ROWS)


def test_ngram_join_finds_chains_that_stars_miss(spark):
    texts = [" ".join(f"w{i}" if i not in range(k * 3, k * 3 + 3) else f"e{k}_{i}" for i in range(90)) for k in range(20)]
    rows = [(k, t, None) for k, t in enumerate(texts)]
    got = {r["doc_id"]: r["component_id"] for r in ngram_join.ngram_join(spark.createDataFrame(rows, DOCS), star_rounds=0, cell=3).collect()}
    sets = [shingles(t) for t in texts]
    linked = [100 * len(a & b) >= 75 * len(a | b) for a, b in itertools.combinations(sets, 2)]
    assert any(linked) and set(got.values()) == {0}


def test_empty_tables(spark):
    none = spark.createDataFrame([], DOCS)
    assert ngram_join.ngram_join(none).count() == 0
    assert mixing.mix(none).count() == 0
    assert fingerprints.edit_likeness(none).count() == 0
    assert repetition.quality_rules(none).count() == 0
    assert automaton.encode_and_decode(none, word_tokenizer()).count() == 0
    assert secret_scan.secret_spans(none, secret_scan.fit(secret_scan.labelled_samples(none))).count() == 0
    assert language.identify(none, {}).count() == 0
    labels = spark.createDataFrame([], "doc_id bigint, toxic int")
    assert toxicity.score(none, toxicity.fit(none, labels)).count() == 0


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101), (101, 100), (5, 5)], "u bigint, v bigint")
    got = {r["node"]: r["label"] for r in components.components(edges).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100}


def test_token_files_round_trip(spark, docs, tmp_path):
    manifest = token_files.write_token_files(docs, word_tokenizer(), str(tmp_path), length=32)
    got = sorted((r["doc_id"], r["start"], r["n_tokens"], bytes(r["ids"])) for r in token_files.read_token_files(manifest, str(tmp_path)).collect())
    tokenizer, start, expected = Tokenizer.from_file(word_tokenizer()), 0, []
    for i, t, _ in sorted(ROWS, key=lambda r: r[0]):
        ids = [*tokenizer.encode(t or "", add_special_tokens=False).ids, 2]
        expected.append((i, start, len(ids), np.array(ids, "<u4").tobytes()))
        start += len(ids)
    assert got == sorted(expected)
    stream = b""
    for row in manifest.orderBy("part").collect():
        file = token_files.TokenFile(row["tokens_file"])
        for i in range(len(file)):
            tokens, mask = file[i]
            assert len(tokens) == len(mask) == 32 and not tokens.flags.owndata
            stream += tokens[mask].astype("<u4").tobytes()
    assert stream == b"".join(x[3] for x in expected)
    masked = token_files.read_sequences(spark, manifest, str(tmp_path)).agg(F.sum(F.size(F.filter("mask", lambda x: x)))).first()[0]
    assert masked == start


def test_secret_spans(spark):
    random = "Zk8Qw2Lx9Vb4Nj7Rt1Yp5Hc3"
    text = f'é API_KEY = "abcdEFGH12" token:secret:abcdefgh AKIA{"Z9" * 8} {"ab12" * 8} plain {random} identifiers_everywhere'
    rows = [(1, text, None), (2, None, None), (3, "", None)] + [(i, "ordinary identifiers everywhere_in the texts " * 3, None) for i in range(4, 30)]
    docs = spark.createDataFrame(rows, DOCS).withColumn("spans", F.lit(1))
    training = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    found = secret_scan.secret_spans(docs, secret_scan.fit(secret_scan.labelled_samples(training)))
    got = {r["doc_id"]: r["s"] for r in found.select("doc_id", secret_scan.written("spans").alias("s")).collect()}
    assert got[2] == got[3] == got[4] == ""
    kinds = [(x.split(":")[0], text[int(x.split(":")[1]) : int(x.split(":")[2])]) for x in got[1].split(",")]
    assert kinds == [("assign", 'API_KEY = "abcdEFGH12'), ("access", "AKIA" + "Z9" * 8), ("hex", "ab12" * 8), ("model", random)]
    clean = found.filter("doc_id = 1").select(secret_scan.redacted(F.col("text"), F.col("spans"))).first()[0]
    assert random not in clean and clean.count("[SECRET]") == 4 and clean.endswith("identifiers_everywhere")


@pytest.mark.parametrize(
    ("html", "text"),
    [
        (None, ""), ("", ""), ("<p>a<p>b<br>c", "a\n\nb\nc"), ("<ul><li>a<li>b<ul><li>c</ul></ul>", "- a\n- b\n  - c"), ("<ol start=3><li>a<li value=7>b</ol>", "3. a\n7. b"),
        ("<table><tr><td>a<td>bbb<tr><td>long<td>c</table>", "a     bbb\nlong  c"), ("<table><tr><td align=right>1<td>x<tr><td>100<td>y</table>", "  1  x\n100  y"),
        ("x<script>no</script><p hidden>no</p><p style='display: none'>no</p><div style='visibility:hidden'>no<b style='visibility:visible'>yes</b></div>", "x\nyes"),
        ("<pre>\n a\n  b</pre>", " a\n  b"), ("<details><summary>s</summary>no</details>", "s"), ("a &amp; <i>b</i>\n c", "a & b c"), ("<table>stray<tr><td colspan=2>ab<tr><td>c<td>d</table>", "stray\nab\nc  d"),
    ],
)
def test_html_layout(html, text):
    assert html_layout.page_text(html) == text


def test_html_deep_nesting_keeps_text():
    assert html_layout.page_text("<div>" * 5000 + "deep" + "</div>" * 5000) == "deep"


def test_repeats_match_brute_force():
    rng = np.random.default_rng(3)
    texts = [" ".join(rng.choice(["a", "b", "c"], rng.integers(0, 60))) for _ in range(60)] + [None, "", "z " * 300, BASE + "\n" + BASE]
    for text, row in zip(texts, repetition.measures(texts), strict=True):
        w = words_of(text)
        lengths = [max((k for j in range(len(w)) if j != i for k in range(len(w) - max(i, j) + 1) if w[i : i + k] == w[j : j + k]), default=0) for i in range(len(w))] if len(w) < 100 else None
        if lengths is None:
            continue
        covered = {p for i, k in enumerate(lengths) if k >= 5 for p in range(i, i + k)}
        windows = {p for i, k in enumerate(lengths) if k >= 5 for p in range(i, i + 5)}
        longest = max([k for k in lengths if k >= 5], default=0)
        assert row[0] == len(w) and row[4] == len(windows) and row[5] == sum(len(w[p]) for p in covered) and row[6] == longest


def test_quality_rules(spark, docs):
    got = {r["doc_id"]: (r["n_words"], r["base_failed"], r["kept"]) for r in repetition.quality_rules(docs).collect()}
    assert got[7] == got[3] == got[5] == (0, True, False) and got[1] == (60, False, True) and got[12] == (12, True, False) and got[10] == (6000, False, True)


def test_mixture(spark, docs):
    got = mixing.mix(docs, block=16).collect()
    assert len(got) == len(ROWS) and sum(r["size"] for r in got) == sum(len(words_of(t)) for _, t, _ in ROWS)
    assert all(r["taken"] <= 2 * r["size"] for r in got)
    sources = {i: s for i, _, s in ROWS}
    for source in set(sources.values()):
        own = [r for r in got if sources[r["doc_id"]] == source]
        assert sum(r["taken"] for r in own) == int(own[0]["target"])
    assert sorted(map(tuple, got)) == sorted(map(tuple, mixing.mix(docs, block=16).collect()))


def test_slot_schedule_covers_quotas_and_spreads(spark):
    targets = spark.createDataFrame([(1, 6400), (2, 3200), (3, 0), (4, 1000)], "source_no int, quota bigint")
    rows = mixing.slot_schedule(targets, block=16).collect()
    for no, quota in ((1, 6400), (2, 3200), (4, 1000)):
        own = sorted((r["begin"], r["end"]) for r in rows if r["source_no"] == no)
        assert own[0][0] == 0 and own[-1][1] == quota and all(a[1] == b[0] for a, b in itertools.pairwise(own))
    first = [r["source_no"] for r in sorted(rows, key=lambda r: r["slot"])][:100]
    assert abs(first.count(1) - 60) <= 3 and abs(first.count(2) - 30) <= 3


def test_fingerprints(spark, docs):
    got = sorted(fingerprints.edit_likeness(docs).collect(), key=lambda r: r["doc_id"])
    rows = sorted(((i, t or "") for i, t, _ in ROWS), key=lambda r: r[0])
    for k, (row, (i, text)) in enumerate(zip(got, rows, strict=True)):
        following = rows[(k + 1) % len(rows)][1]
        half = len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        assert (row["doc_id"], row["n_chars"], row["edited_sha256"]) == (i, len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert 0 <= row["near_edited"] <= 1 and 0 <= row["near_next"] <= 1
    by_id = {r["doc_id"]: r for r in got}
    assert by_id[10]["near_next"] > 0.97 and by_id[1]["near_next"] > 0.6 and by_id[3]["fingerprint"] == ""
    scheme = fingerprints.OnePermutation(stored_bits=4)
    values = scheme.values(LONG.encode())
    assert (scheme.unpacked(scheme.packed(values)) == values).all()


def test_automaton_agrees_with_the_library(spark, docs):
    tokenizer = Tokenizer.from_file(word_tokenizer())
    for row in automaton.encode_and_decode(docs, word_tokenizer()).collect():
        ids = tokenizer.encode(row["text"] or "", add_special_tokens=False).ids
        assert row["ids"] == ids and row["decoded"] == tokenizer.decode(ids, skip_special_tokens=False) and row["n"] == "clash"
    machine, rng = automaton.WordTokenizer(open(word_tokenizer(), encoding="utf-8").read()), np.random.default_rng(5)
    for _ in range(3000):
        text = "".join(rng.choice(list("aeelstinÉß'. 1"), rng.integers(0, 30)))
        assert machine.encode(text).tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_language_on_held_out_rows(spark):
    rows = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    held = language.remainder("doc_id", 4) == 2
    learned = language.fit(rows.filter(~held))
    got = language.identify(rows.filter(held).drop("source"), learned).collect()
    assert sum(r["lang"] == r["lang_pred"] for r in got) >= 0.9 * len(got)
    odd = language.identify(spark.createDataFrame([(1, None, None), (2, "", None), (3, "12 .", None)], DOCS), learned)
    assert {r["lang_pred"] for r in odd.collect()} == {"und"}
    assert rows.select(language.remainder("doc_id", 4)).first()[0] == zlib.crc32(str(rows.first()["doc_id"]).encode()) % 4


def test_toxicity_shares_subwords():
    rng = np.random.default_rng(2)
    plain = [" ".join(rng.choice(["river", "stone", "garden", "window", "letter", "morning", "silver"], 40)) for _ in range(120)]
    bad = [p.replace("stone", "horrible", 1) for p in plain[:60]]
    margins, bias = toxicity.train(bad + plain[60:], [1] * 60 + [0] * 60)

    def logit(word):
        own = toxicity.grams(word)
        return margins[:, own].sum() / len(own) + bias  # a text of this word alone: its bag and its run

    assert logit("horrible") > 0 and logit("horribble") > 0 and logit("garden") < 0
    assert pa.array([bias]).type == pa.float64()


def test_pipeline_keeps_one_document_of_a_group(spark):
    import corpus_pipeline

    words = " ".join(f"w{i}" for i in range(40))
    rows = [
        (3, words, "en", "a", 1), (7, words + " end", "en", "b", 2), (7, words + " end", "en", "b", 2), (9, "other text of its own here", None, None, 3),
        (9, "a second text under one id", "en", "c", 4), (None, words, "en", "a", 5), (None, "no id and no kin at all", "en", "a", 6),
        (0, None, "en", "a", 0), (12, "", "en", "a", 0),
    ]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    out = corpus_pipeline.near_duplicates(spark, docs, "")
    assert out.columns == corpus_pipeline.COLUMNS and out.schema["doc_id"].dataType.simpleString() == "bigint"
    got = sorted(((r["doc_id"], r["text"]) for r in out.collect()), key=repr)
    kept = [(3, words), (9, "other text of its own here"), (9, "a second text under one id"), (None, "no id and no kin at all"), (0, None), (12, "")]
    assert got == sorted(kept, key=repr)
    assert corpus_pipeline.near_duplicates(spark, docs.limit(0), "").count() == 0
