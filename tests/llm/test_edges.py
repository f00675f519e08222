"""Nulls, empty tables, very long and repeated texts, clashing columns, and results against plain Python."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from millrace.llm import automaton, bytewords, fingerprints, html_layout, language, mixing, ngram_join, queries, ranges, repetition, sampling, secret_scan, token_files, toxicity
from millrace.llm.queries import word_tokenizer

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def by_repr(rows):
    return sorted(rows, key=repr)


def with_odd_columns(docs):
    """Columns whose names need quoting, and a struct whose fields do."""
    return docs.withColumn("a `b`", F.struct(F.lit(2).alias("c d"))).withColumn("x y", F.lit(1))


# columns of any name pass through


@pytest.mark.parametrize(
    ("added", "run"),
    [
        (["ids", "decoded"], lambda docs: automaton.encode_and_decode(docs, word_tokenizer())),
        (["fingerprint"], fingerprints.fingerprints),
        (["lang_pred", "score", "rejected"], lambda docs: language.identify(docs, {"en": (b"the and of", 1.0)})),
        (["score"], lambda docs: toxicity.score(docs, (np.zeros((2, toxicity.BUCKETS), np.float32).tobytes(), -8.0))),
        (["base_failed", "kept", "n_words"], repetition.quality_rules),
        (["base", "spans"], lambda docs: secret_scan.secret_spans(docs, [0.0] * secret_scan.STATES**2)),
    ],
)
def test_odd_and_clashing_columns(spark, added, run):
    rows = [(1, None, "en", None, 0), (None, "", None, "s", 0), (2, "same words", "en", "s", 9), (2, "same words", "en", "s", 9), (3, "w é " * 60_000, "en", "s", 9)]
    docs = with_odd_columns(spark.createDataFrame(rows, DOCS))
    for name in added:
        docs = docs.withColumn(name.upper(), F.lit("clash"))
    out = run(docs)
    assert out.columns[:7] == [*DOCS.replace(" bigint", "").replace(" string", "").split(", "), "a `b`", "x y"] and set(added) <= set(out.columns)
    got = out.collect()
    assert Counter((r["doc_id"], r["text"]) for r in got) == Counter((r[0], r[1]) for r in rows)
    same = [tuple(r)[5:] for r in got if r["text"] == "same words"]
    assert same[0] == same[1] and run(docs.limit(0)).count() == 0


def test_html_of_odd_tables(spark):
    page = "<p>one</p><svg><defs><text>not</text></defs><g><text>axis <tspan>two</tspan></text><title>no</title></g></svg><input type=submit value='Send it'><input value=secret>"
    rows = [(1, None), (2, ""), (3, page), (3, page), (None, "<p>" + "word " * 50_000)]
    pages = with_odd_columns(spark.createDataFrame(rows, "page_id bigint, html string")).withColumn("Text", F.lit("clash"))
    got = [(r["page_id"], r["text"]) for r in html_layout.extract_text(pages).collect()]
    shown = "one\n\naxis two\nSend it"
    assert by_repr(got) == by_repr([(1, ""), (2, ""), (3, shown), (3, shown), (None, ("word " * 50_000).strip())])
    whole = queries.op4_html_text(spark, "/root/testdata/sf0.001")
    plain = {r["page_id"]: html_layout.page_text(r["html"]) for r in spark.read.parquet("/root/testdata/sf0.001/pages.parquet").collect()}
    assert {r["page_id"]: r["text"] for r in whole.collect()} == plain


def test_rules_of_style_elements():
    css = """/* .all { display:none } */ .ad, #menu li.off { display: none } p { margin: 0 } div > span { visibility:hidden } .ad.shown { display: block }
    @media print { .body { display: none } } @media screen { .small { DISPLAY:none } } a:hover { display: none } .last { display: none !important } b { display: none; color: red }"""
    page = f"""<head><style>{css}</style><style media=print>p {{ display: none }}</style></head><body><p class="body x">kept</p><p class=ad>no</p><p class='ad shown'>yes</p>
    <ul id=menu><li class=off>no</li><li>item</li></ul><ul><li class=off>other</li></ul><div>text <span>no</span> <i><span>deep</span></i></div>
    <p class=small>no</p><a>link</a><p class=last style='display:block'>no</p><p><b style='display:inline'>bold</b> <b>no</b></p><style>p.late {{display:none}}</style><p class=late>no</p></body>"""
    assert html_layout.page_text(page) == "kept\n\nyes\n\n- item\n\n- other\n\ntext deep\nlink\n\nbold"
    assert html_layout.page_text("<style>.a{display:none</style><p class=a>x") == "" and html_layout.page_text("<style>{}{ } .a } {display:none}</style><p class=a>x") == "x"


# ranges of ids, token files, fingerprints


def test_hot_and_missing_ids_are_split(spark):
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    try:
        rows = [(None if i % 3 == 0 else 77 if i % 3 == 1 else i, f"text {i}") for i in range(3000)]
        dealt, parts = ranges.with_ranges(spark.createDataFrame(rows, "doc_id bigint, text string"))
        sizes = Counter(r["part"] for r in dealt.select("part").collect())
        assert max(sizes) < parts and max(sizes.values()) < 800
        order = sorted((r["part"], r["doc_id"] is not None, r["doc_id"] or 0, r["turn"]) for r in dealt.collect())
        assert [x[1:] for x in order] == sorted(x[1:] for x in order)
        assert ranges.with_ranges(dealt.drop("part").limit(0))[0].count() == 0
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_long_lists_of_limits(spark):
    limits = sorted({(k // 3, (k % 3) / 3) for k in range(1000)})
    rows = spark.range(400).select((F.col("id") - 20).alias("key"), (F.col("id") % 7 / 7).alias("turn"))
    for r in rows.withColumn("n", ranges._reached(limits, F.col("key"), F.col("turn"))).collect():
        assert r["n"] == sum(x <= (r["key"], r["turn"]) for x in limits)


def test_token_files_of_odd_tables(spark, tmp_path):
    rows = [(None, "no id"), (None, None), (5, "same"), (5, "same"), (5, "other"), (1, ""), (-3, "first words here")]
    manifest = token_files.write_token_files(spark.createDataFrame(rows, "doc_id bigint, text string"), word_tokenizer(), str(tmp_path / "a"), length=4)
    got = sorted((r["start"], r["doc_id"], bytes(r["ids"])) for r in token_files.read_token_files(manifest, str(tmp_path / "a")).collect())
    coder = Tokenizer.from_file(word_tokenizer())
    expected = [(i, np.array([*coder.encode(t or "", add_special_tokens=False).ids, 2], "<u4").tobytes()) for i, t in rows]
    assert by_repr(x[1:] for x in got) == by_repr(expected)
    assert [x[1] for x in got] == [None, None, -3, 1, 5, 5, 5]
    assert [x[0] for x in got] == np.cumsum([0, *[len(x[2]) // 4 for x in got[:-1]]]).tolist()
    empty = token_files.write_token_files(spark.createDataFrame([], "doc_id bigint, text string"), word_tokenizer(), str(tmp_path / "b"))
    assert empty.count() == 0 and token_files.read_token_files(empty, str(tmp_path / "b")).count() == 0


def test_fingerprints_estimate_jaccard(spark):
    rng = random.Random(4)
    vocabulary = [f"w{i}" for i in range(4000)]
    scheme, errors = fingerprints.OnePermutation(), []
    for _ in range(60):
        one = [rng.choice(vocabulary) for _ in range(400)]
        two = [w if rng.random() < 0.97 else rng.choice(vocabulary) for w in one]
        sets = [{tuple(x[i : i + 5]) for i in range(396)} for x in (one, two)]
        exact = len(sets[0] & sets[1]) / len(sets[0] | sets[1])
        errors.append(scheme.likeness(*(scheme.values(" ".join(x).encode()) for x in (one, two))) - exact)
    assert abs(np.mean(errors)) < 0.03 and np.max(np.abs(errors)) < 0.2


def test_ngram_join_with_fragments_cut_further(spark, monkeypatch):
    rng = random.Random(12)
    base = [[f"w{rng.randint(0, 300)}" for _ in range(40)] for _ in range(8)]
    rows = []
    for i in range(60):
        words = list(base[i % 8])
        for _ in range(rng.choice([0, 0, 1, 3])):
            words[rng.randrange(40)] = f"x{rng.randint(0, 9)}"
        rows.append((i, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    plain = by_repr(map(tuple, ngram_join.ngram_join(docs).collect()))
    monkeypatch.setattr(ngram_join, "FRAGMENTS", 3)
    monkeypatch.setattr(ngram_join, "BLOCK", 200)
    monkeypatch.setattr(ngram_join, "PART_BYTES", 100)
    assert by_repr(map(tuple, ngram_join.ngram_join(docs).collect())) == plain
    sets = [{tuple(t.split()[k : k + 5]) for k in range(36)} for _, t in rows]
    least = list(range(60))
    for _ in range(60):
        for i in range(60):
            for j in range(60):
                if 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                    least[i] = min(least[i], least[j])
    assert plain == by_repr((i, len(sets[i]), least[i]) for i in range(60))


# secrets


def plain_base(text):
    found = [(m.start(), 0, m.end(), "assign") for m in re.finditer(r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text) if len(m[2]) >= 8]
    found += [(m.start(), 1, m.end(), "access") for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    found += [(m.start(), 2, m.end(), "hex") for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 32]
    return [(kind, a, b) for a, _, b, kind in sorted(found)]


def test_base_spans_of_whole_table(spark):
    folder = "/root/testdata/sf0.01"
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    for r in queries.op3_secret_scan(spark, folder).collect():
        base = plain_base(texts[r["doc_id"]])
        assert r["base_sha256"] == hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in base).encode()).hexdigest()
        assert [r[f"n_{k}"] for k in ("assign", "access", "hex")] == [sum(x[0] == k for x in base) for k in ("assign", "access", "hex")]
        assert set(f"{k}:{a}:{b}" for k, a, b in base) <= set(r["spans"].split(",")) or not base


def test_spans_of_many_secrets_and_odd_texts(spark):
    rng = random.Random(9)

    def hexes(n):
        return "".join(rng.choice("0123456789abcdef") for _ in range(n))

    many = " ".join(rng.choice(["é", f"password: {hexes(12)}", hexes(40), "AKIA" + hexes(16).upper(), f"token={hexes(40)}"]) for _ in range(5000))
    tied = "secret: " + "a" * 40 + ' api_key="' + "AKIA" + "B" * 20 + '" ' + "f" * 31
    rows = [(1, many), (2, tied), (3, tied), (3, tied), (4, None), (5, ""), (6, "é" * 100_000 + " passwd=" + "x" * 9)]
    ratios = [0.0] * secret_scan.STATES**2
    found = secret_scan.secret_spans(spark.createDataFrame(rows, "doc_id bigint, text string"), ratios)
    for r in found.withColumn("clean", secret_scan.redacted(F.col("text"), F.col("spans"))).collect():
        text, out, at = r["text"] or "", [], 0
        assert [(s["kind"], s["start"], s["end"]) for s in r["base"]] == plain_base(text)
        for s in r["spans"]:
            if s["start"] >= at:
                out.append(text[at : s["start"]] + "[SECRET]")
            at = max(at, s["end"])
        assert r["clean"] == (None if r["text"] is None else "".join(out) + text[at:])


def test_model_spans_touch_no_other(spark):
    long = "Zk8Qw2Lx9Vb4Nj7Rt1Yp5Hc3"
    text = f"{long} password={long} {long}{'0' * 40} {long}\n{long}"
    ratios = [1.0] * secret_scan.STATES**2
    row = secret_scan.secret_spans(spark.createDataFrame([(1, text)], "doc_id bigint, text string"), ratios).first()
    free = [(m.start(), m.end()) for m in re.finditer(r"[A-Za-z0-9+/_=-]{16,}", text)]
    base = [(s["start"], s["end"]) for s in row["base"]]
    expected = [f for f in free if not any(a < f[1] and f[0] < b for a, b in base)]
    assert [(s["start"], s["end"]) for s in row["spans"] if s["kind"] == "model"] == expected and len(expected) == 3


# mixture


def test_every_window_of_slots_holds_the_shares(spark):
    quotas = [70_000, 30_000, 15_000, 9_000, 300]
    targets = spark.createDataFrame(list(enumerate(quotas, 1)), "source_no int, quota bigint")
    rows = mixing.slot_schedule(targets, 16).collect()
    slots = -(-sum(quotas) // 16)
    scheduled = sorted((r["slot"], r["source_no"], r["block_no"]) for r in rows if r["slot"] < slots)
    owner = np.zeros(slots, np.int64)
    for slot, source, _ in scheduled:
        owner[slot] = source
    for source, quota in enumerate(quotas, 1):
        share, seen = quota / sum(quotas), np.cumsum(np.r_[0, owner == source])
        # the stated bound: a window of k golden-ratio points misses a share by at most 2 + 1.5 log2(k) points
        for k in (1, 2, 5, 10, 50, 100, 1000, 5000):
            counts = seen[k:] - seen[:-k]
            assert np.abs(counts - k * share).max() <= 2 + 1.5 * np.log2(k), (source, k)
        blocks = [b for _, s, b in scheduled if s == source]
        assert blocks == list(range(len(blocks)))
    covered = Counter()
    for r in rows:
        covered[r["source_no"]] += r["end"] - r["begin"]
    assert [covered[i] for i in range(1, 6)] == quotas


def test_mix_of_repeated_and_odd_rows(spark):
    rows = [(7, "one two three", "a")] * 40 + [(None, "four five", None)] * 30 + [(None, None, "a"), (3, "", None), (4, " ", "b")] + [(i, f"w{i} " * 30, "b") for i in range(20)]
    docs = with_odd_columns(spark.createDataFrame(rows, "doc_id bigint, text string, source string").withColumn("size", F.lit(-1)))
    got = mixing.mix(docs, block=8).collect()
    assert Counter(r["doc_id"] for r in got) == Counter(r[0] for r in rows)
    for source, size in (("a", 120), (None, 60), ("b", 600)):
        own = [r for r in got if r["source_size"] == size and (r["size"] or r["doc_id"] is None or source != "b")]
        assert sum(r["taken"] for r in own) == int(own[0]["target"]) and all(r["taken"] <= 2 * r["size"] for r in own)
    assert all((r["taken"] > 0) == (r["first_slot"] is not None) and (r["first_slot"] or 0) <= (r["last_slot"] or 0) for r in got)
    assert by_repr(map(tuple, got)) == by_repr(map(tuple, mixing.mix(docs.repartition(5), block=8).collect()))


def test_first_words_keep_line_ends(spark):
    text = "  a b\n\nc  dé "
    frame = spark.createDataFrame([(text, k) for k in range(1, 5)] + [(text.strip(), k) for k in range(1, 5)], "text string, k int")
    got = [r[0] for r in frame.select(mixing.first_words(F.col("text"), F.col("k"))).collect()]
    assert got == ["  a", "  a b", "  a b\n\nc", "  a b\n\nc  dé", "a", "a b", "a b\n\nc", "a b\n\nc  dé"]


# samples


def test_least_drawn_rows(spark):
    rows = [(i, hashlib.md5(str(i).encode()).hexdigest()) for i in range(3000)] + [(None, hashlib.md5(b"").hexdigest())] * 40
    frame = spark.createDataFrame(rows, "doc_id bigint, number string").withColumn("draw", sampling.draw_of())
    assert frame.filter("draw <> number").count() == 0
    for k in (1, 50, 1400, 5000):
        expected = sorted((d, i is not None, i or 0) for i, d in rows)[:k]
        got = sampling.least_drawn(frame.select("draw", "doc_id").repartition(9), "draw", ["draw", F.col("doc_id").asc_nulls_first()], k).collect()
        assert sorted((r["draw"], r["doc_id"] is not None, r["doc_id"] or 0) for r in got) == expected
    assert sampling.wanted_share(10, 5) == 1.0 and sampling.wanted_share(10**6, 300) < 0.001


def test_language_sample_is_the_least_drawn(spark):
    rows = [(i, f"word{i} text", "en" if i % 50 else "de") for i in range(4000)]
    learned = language.fit(spark.createDataFrame(rows, "doc_id bigint, text string, lang string").repartition(11), documents=40)
    for lang in ("en", "de"):
        order = sorted((hashlib.md5(str(i).encode()).hexdigest(), t) for i, t, own in rows if own == lang)
        assert learned[lang][0] == "\n".join(t for _, t in order[:40]).encode()


# language and toxicity


def test_language_samples_whole_texts(spark):
    assert language.shared_out([[b"aaaa", b"bbbb"], [b"c"]], 100) == b"aaaa\nbbbb\nc"
    cut = language.shared_out([[b"a" * 50, b"b" * 50], [b"c" * 100], [b"d"]], 42)
    assert cut.count(b"a") == cut.count(b"b") > 5 and cut.count(b"c") == 19 and cut.count(b"d") == 1 and len(cut) <= 42
    head, tail = "x" * 5000, "the quick brown fox " * 50
    learned = language.fit(spark.createDataFrame([(1, head + tail, "en"), (2, "z" * 3000, "de"), (3, None, "en"), (4, "", "fr"), (5, "w", None)], "doc_id bigint, text string, lang string"))
    assert set(learned) == {"en", "de"} and b"quick brown" in learned["en"][0] and language.fit(spark.createDataFrame([], "doc_id bigint, text string, lang string")) == {}
    rows = [(1, "the quick brown fox " * 20_000), (1, "the quick brown fox " * 20_000), (2, "z" * 100), (3, None), (4, "12 3")]
    got = language.identify(spark.createDataFrame(rows, "doc_id bigint, text string"), learned).collect()
    assert Counter((r["doc_id"], r["lang_pred"]) for r in got) == Counter([(1, "en"), (1, "en"), (2, "de"), (3, "und"), (4, "und")])


@pytest.mark.parametrize(("scale", "least_recall", "most_alarms"), [("sf0.01", 0.7, 0.02), ("sf0.1", 0.8, 0.01)])
def test_toxicity_on_held_out_rows(spark, scale, least_recall, most_alarms):
    folder = f"/root/testdata/{scale}"
    truth = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{folder}/labels.parquet").filter("toxic is not null").collect()}
    got = queries.op9_toxicity(spark, folder).collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in got)
    held = [(truth[r["doc_id"]], r["predicted"]) for r in got if r["held_out"] and r["doc_id"] in truth]
    toxic, clean = [p for t, p in held if t], [p for t, p in held if not t]
    assert sum(toxic) >= least_recall * len(toxic) and sum(clean) <= most_alarms * len(clean)


def test_toxicity_of_odd_rows(spark):
    rows = [(i, "river stone garden window letter " * 6 + ("horrible filth " if i % 2 else ""), None) for i in range(60)] + [(None, "horrible filth", 1), (7, None, 1)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, score int")
    labels = docs.filter("doc_id is not null").select("doc_id", (F.col("doc_id") % 2).cast("int").alias("toxic")).union(spark.createDataFrame([(7, 0), (None, 1), (9999, 1)], "doc_id bigint, toxic int"))
    model = toxicity.fit(docs, labels)
    odd = spark.createDataFrame([(1, None), (2, ""), (3, "horrible filth"), (3, "horrible filth"), (4, "river stone " * 50_000), (5, "horible filth")], "doc_id bigint, text string")
    got = {r["doc_id"]: r["score"] for r in toxicity.score(odd, model).collect()}
    assert got[1] == got[2] == 0 and got[3] > 0.7 and got[4] < 0.3 and got[5] > 0.5


# quality rules


def test_quality_numbers_against_plain_python(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()] + [(-1, None), (-2, ""), (-3, "a b\n\na b\n \nc"), (-4, "# $ é|\x0b#")]
    got = {r["doc_id"]: r for r in repetition.quality_rules(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    for doc_id, text in rows:
        words, lines = WORD.findall(text or ""), [x for x in (text or "").split("\n") if WORD.search(x)]
        windows = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
        hit = {j for i in range(len(words) - 4) if windows[tuple(words[i : i + 5])] > 1 for j in range(i, i + 5)}
        expected = (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(hit))
        row = got[doc_id]
        assert (row["n_words"], row["word_chars"], row["n_symbols"], row["n_dup_lines"], row["n_repeat_words"]) == expected
        assert row["base_failed"] == (expected[0] < 10 or 100 * expected[4] > 20 * expected[0]) and not (row["base_failed"] and row["kept"])


# words of bytes


def test_words_of_bytes():
    texts = ["a bé\tc", None, "", " x", "y", "\x0b z\r\n"]
    words = bytewords.find_words(*bytewords.text_bytes(pa.array(texts)), bytewords.NON_SPACE)
    assert words.array().to_pylist() == [w.encode() for t in texts for w in WORD.findall(t or "")] and words.ends.tolist() == [3, 3, 3, 4, 5, 6]
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], ["text"])
    for most in (1, 3, 100):
        parts = list(bytewords.slices_of(batch.slice(1), "text", most))
        assert [x for p in parts for x in p.column("text").to_pylist()] == texts[1:]


# pipeline


def test_mixture_stage_against_mix(spark, tmp_path):
    rng = random.Random(8)
    rows = [(rng.choice([None, i, 5]), rng.choice([None, "", "q\n" * 30, "é  w\nv " * rng.randint(1, 90)]), None, rng.choice(["a", "b", None]), 1) for i in range(150)]
    spark.createDataFrame(rows, DOCS).repartition(3).write.parquet(str(tmp_path / "docs"))
    docs = spark.read.parquet(str(tmp_path / "docs"))
    corpus_pipeline.mixture(spark, docs, "").write.parquet(str(tmp_path / "out"))
    out = spark.read.parquet(str(tmp_path / "out")).collect()
    taken = sum(r["taken"] for r in mixing.mix(docs).collect())
    assert sum(len(WORD.findall(r["text"])) for r in out) == taken > 0
    texts = {r[1] for r in rows if r[1]}
    for r in out:
        whole = r["text"] in texts
        assert whole or any(t.startswith(r["text"]) and not t[len(r["text"])].strip() for t in texts if len(t) > len(r["text"]))
        assert r["n_chars"] == (1 if whole else len(r["text"]))
    assert sum(r["text"] not in texts for r in out) <= 6  # at most one cut for each source and pass
    assert corpus_pipeline.mixture(spark, docs.limit(0), "").count() == 0


def test_stages_against_plain_python(spark):
    clean = " ".join(f"word{i}" for i in range(60))
    rows = [
        (1, clean, "en", "a", 1), (2, clean + " end", "en", "b", 2), (3, "same words again " * 30, "en", "a", 3), (4, None, None, None, None), (5, "", "en", "a", 0),
        (6, " ".join(f"other{i}" for i in range(40)) + " password=abcdefgh12345", "de", "a", 6), (None, " ".join(f"none{i}" for i in range(40)), "en", None, 7),
    ]
    docs = spark.createDataFrame(rows, DOCS)
    kept = corpus_pipeline.quality(spark, docs, "")
    assert {r["doc_id"] for r in kept.collect()} == {1, 2, 6, None} and kept.columns == corpus_pipeline.COLUMNS
    single = corpus_pipeline.near_duplicates(spark, kept, "")
    assert {r["doc_id"] for r in single.collect()} == {1, 6, None}
    cleaned = {r["doc_id"]: r for r in corpus_pipeline.secrets(spark, single, "").collect()}
    assert cleaned[6]["text"].endswith(" [SECRET]") and cleaned[6]["n_chars"] == len(cleaned[6]["text"]) and cleaned[1]["text"] == clean and cleaned[1]["n_chars"] == 1
    coder = Tokenizer.from_file(word_tokenizer())
    for r in corpus_pipeline.tokens(spark, docs, "").collect():
        text = next(x[1] for x in rows if x[0] == r["doc_id"]) or ""
        ids = coder.encode(text, add_special_tokens=False).ids
        assert r["ids"] == ids and r["n_tokens"] == len(ids) and r["decoded_sha256"] == hashlib.sha256(coder.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_run_keeps_and_counts_like_its_stages(spark):
    folder = "/root/testdata/sf0.001"
    out = corpus_pipeline.run(spark, folder).collect()
    docs = queries.table(spark, folder, "documents")
    for name, stage in corpus_pipeline.STAGES[:3]:
        docs = spark.createDataFrame(stage(spark, docs, folder).collect(), DOCS)
    words = {r["doc_id"]: len(WORD.findall(r["text"] or "")) for r in docs.collect()}
    assert {r["doc_id"] for r in out} <= set(words) and len(words) < 200
    mixed = {r["doc_id"]: r["taken"] for r in mixing.mix(docs).collect()}
    assert {r["doc_id"] for r in out} == {i for i, n in mixed.items() if n} and max(Counter(r["doc_id"] for r in out).values()) <= 2
