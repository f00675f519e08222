"""Periodic runs, Merkle manifest and benchmark passages against brute force, and their edge cases."""

import hashlib
import itertools
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import decontaminate, merkle, periodic_runs, queries

WORD = re.compile(r"[^\x20\x09-\x0D]+")
ITEM_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def by_repr(rows):
    return sorted(rows, key=repr)


# periodic runs


def plain_runs(words, least):
    seen, out = set(), []
    for q in range(1, len(words) // 2 + 1):
        equal, i = [a == b for a, b in zip(words, words[q:])], 0
        while i < len(equal):
            if not equal[i]:
                i += 1
                continue
            start = i
            while i < len(equal) and equal[i]:
                i += 1
            length = i - start + q
            if length >= max(least, 2 * q) and (start, length) not in seen:
                seen.add((start, length))
                out.append((start, length, q))
    return sorted(out, key=lambda r: (r[0], r[2]))


def runs_of_texts(texts, least):
    ids, ends = np.array([c for t in texts for c in t], np.int64), np.cumsum([len(t) for t in texts])
    begins, out = np.r_[0, ends[:-1]], [[] for _ in texts]
    for start, length, period in zip(*(x.tolist() for x in periodic_runs.find_runs(ids, ends, least))):
        own = int(np.searchsorted(ends, start, side="right"))
        out[own].append((start - int(begins[own]), length, period))
    return out


def test_runs_of_all_short_words():
    for letters, longest, least in ((2, 13, 2), (3, 8, 3)):
        for n in range(1, longest + 1):
            texts = list(itertools.product(range(letters), repeat=n))
            assert runs_of_texts(texts, least) == [plain_runs(t, least) for t in texts]


def test_runs_of_repetitive_texts():
    rng = random.Random(1)
    for _ in range(150):
        texts = []
        for _ in range(4):
            text = []
            while len(text) < rng.randint(0, 250):
                part = text[-rng.randint(1, 60) :] if text and rng.random() < 0.4 else [rng.randint(0, rng.choice([1, 2, 5])) for _ in range(rng.randint(1, 40))]
                text += (part * rng.randint(1, 6))[: rng.randint(1, 200)]
            texts.append(text)
        assert runs_of_texts(texts, 12) == [plain_runs(t, 12) for t in texts]
    assert runs_of_texts([[0] * 300_000], 12) == [[(0, 300_000, 1)]]


def test_periodic_runs_edge_cases(spark):
    again = " ".join(["one two three"] * 6)
    rows = [
        (1, None, None, "a", 0), (2, "", "en", "a", 0), (3, " \t\n", "en", "a", 3), (4, again, "en", None, 9), (4, again, "en", None, 9), (None, "x\n" + again + " y", "en", "a", 1),
        (5, "é " * 11, "en", "a", 1), (6, "é " * 12, "en", "a", 1), (7, "w " * 200_000, "en", "a", 1),
    ]
    docs = spark.createDataFrame(rows, DOCS).withColumn("Runs", F.lit(1)).withColumn("a `b`", F.struct(F.lit(2).alias("c d")))
    out = periodic_runs.periodic_runs(docs)
    assert out.columns == ["doc_id", "text", "lang", "source", "n_chars", "a `b`", "n_words", "runs", "collapsed"]
    got = [(r["doc_id"], r["n_words"], [tuple(x) for x in r["runs"]], r["collapsed"]) for r in out.collect()]
    once = (4, 18, [(0, 18, 3)], "one two three")
    expected = [(1, 0, [], ""), (2, 0, [], ""), (3, 0, [], ""), once, once, (None, 20, [(1, 18, 3)], "x one two three y"), (5, 11, [], " ".join("é" * 11)), (6, 12, [(0, 12, 1)], "é"), (7, 200_000, [(0, 200_000, 1)], "w")]
    assert by_repr(got) == by_repr(expected)
    assert periodic_runs.periodic_runs(docs.limit(0)).count() == 0


def test_op11_against_brute_force(spark):
    def told(doc_id, text):
        words = WORD.findall(text or "")
        n, h = len(words), zlib.crc32(str(doc_id).encode())
        if h % 10 == 0 and n:
            a = h // 10 % n
            p = 1 + (n - a) // (3 + h // 10 % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        runs = plain_runs(words, 12)
        gone = {i for s, l, q in runs for i in range(s + q, s + l)}
        best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else None
        facts = (best[0], best[1], best[2], 1000 * best[1] // best[2]) if best else (None,) * 4
        return doc_id, len(runs), *facts, digest("".join(f"{s},{l},{q}\n" for s, l, q in runs)), digest(" ".join(w for i, w in enumerate(words) if i not in gone))

    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    got = [tuple(r) for r in queries.op11_periodic_runs(spark, folder).collect()]
    assert by_repr(got) == by_repr(told(*r) for r in docs) and sum(r[1] > 0 for r in got) > 20


# Merkle manifest


def field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def leaf(row, text):
    return digest(*(field(row[c]) for c in ("doc_id", "source", "lang", "n_chars")), field(text))


def plain_tree(leaves):
    paths, own, level = [[] for _ in leaves], list(range(len(leaves))), leaves
    while len(level) > 1:
        for i, k in enumerate(own):
            first = k - k % 3
            paths[i].append((level[first:k], level[k + 1 : first + 3]))
        own, level = [k // 3 for k in own], [digest(*level[i : i + 3]) for i in range(0, len(level), 3)]
    return level[0], paths


def plain_manifest(rows):
    groups = defaultdict(list)
    for row in rows:
        groups[row["source"]].append((row["doc_id"] is not None, row["doc_id"] or 0, leaf(row, row["text"]), row))
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = [plain_tree([x[2] for x in sorted(groups[s], key=lambda x: x[:3])]) for s in names]
    root, tops = plain_tree([t[0] for t in trees])
    out = []
    for name, (subroot, paths), top in zip(names, trees, tops):
        for (_, _, own, row), path in zip(sorted(groups[name], key=lambda x: x[:3]), paths):
            text = row["text"]
            if text is not None and row["doc_id"] is not None and zlib.crc32(str(row["doc_id"]).encode()) % 2 == 0:
                text = text.replace("\n", "")
            fold = leaf(row, text)
            for before, after in path + top:
                fold = digest(*before, fold, *after)
            out.append((row["doc_id"], own, subroot, root, digest(*(d for step in path + top for side in step for d in side)), fold, fold == root))
    return out


@pytest.mark.parametrize(
    ("count", "sources"),
    [(1, ["a"]), (1, [None]), (2, ["a"]), (5, [None, "b"]), (40, [f"s{i}" for i in range(30)]), (400, ["é", "z", "", None, "a", "a", "a", "a"])],
)
def test_manifest_of_small_tables(spark, count, sources):
    rng = random.Random(count)
    rows = [(rng.choice([None, rng.randint(0, 50)]), rng.choice([None, "", "a\nb", "x y\n", "é" * 1000]), rng.choice([None, "en"]), rng.choice(sources), rng.choice([None, 3])) for _ in range(count)]
    docs = spark.createDataFrame(rows, DOCS)
    expected = plain_manifest([r.asDict() for r in docs.collect()])
    more = docs.withColumn("leaf", F.lit(1)).withColumn("_key", F.lit("clash")).withColumn("steps", F.lit(0)).repartition(3)
    assert by_repr(tuple(r) for r in queries.merkle_proofs(more).collect()) == by_repr(expected)


def test_manifest_of_no_rows(spark):
    out = queries.merkle_proofs(spark.createDataFrame([], DOCS))
    assert out.count() == 0 and out.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def test_op12_against_brute_force(spark):
    folder = "/root/testdata/sf0.01"
    rows = [r.asDict() for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    got = [tuple(r) for r in queries.op12_merkle_manifest(spark, folder).collect()]
    assert by_repr(got) == by_repr(plain_manifest(rows)) and 0 < sum(not r[-1] for r in got) < len(got)


def test_manifest_detects_any_change(spark):
    docs = spark.createDataFrame([(i, f"text {i}", None, f"s{i % 4}", i) for i in range(60)], DOCS)
    held = merkle.manifest(docs, merkle.leaf_of(merkle.written(F.col("text"))), "source", "doc_id")
    changed = held.select(
        (merkle.folded(F.col("leaf"), F.col("steps")) == F.col("root")).alias("own"), (merkle.folded(F.sha2("leaf", 256), F.col("steps")) == F.col("root")).alias("other")
    )
    assert {(r["own"], r["other"]) for r in changed.collect()} == {(True, False)}


# benchmark passages


def item_words(text):
    return ITEM_WORD.findall((text or "").translate(LOWER))


def plain_hits(docs, items, size):
    windows = defaultdict(set)
    for item, text in items:
        words = item_words(text)
        n = min(size, len(words))
        for i in range(len(words) - n + 1 if n else 0):
            windows[tuple(words[i : i + n])].add(item)
    out = []
    for doc_id, text in docs:
        words, hit, found = item_words(text), set(), set()
        for n in sorted({len(w) for w in windows}):
            for i in range(len(words) - n + 1):
                named = windows.get(tuple(words[i : i + n]))
                if named:
                    hit.update(range(i, i + n))
                    found |= named
        spans = [i for i in sorted(hit) if i - 1 not in hit], [i + 1 for i in sorted(hit) if i + 1 not in hit]
        out.append((doc_id, len(words), list(zip(*spans)), sorted(str(x) for x in found if x is not None)))
    return out


def hits(docs, items, **more):
    return [(r["doc_id"], r["n_words"], [tuple(x) for x in r["hits"]], list(r["items"])) for r in decontaminate.benchmark_hits(docs, items, **more).collect()]


@pytest.mark.parametrize("seed", range(4))
def test_hits_of_small_tables(spark, seed):
    rng = random.Random(seed)
    vocabulary = ["a", "B", "cé", "d9", "é", "x"][: 2 + seed]

    def made(longest):
        return rng.choice([None, ""]) if rng.random() < 0.1 else rng.choice([" ", "-", "\n"]).join(rng.choice(vocabulary) for _ in range(rng.randint(0, longest)))

    docs = [(rng.choice([None, 1, i]), made(rng.choice([5, 40, 200]))) for i in range(50)]
    items = [(rng.choice([None, i, 7]), made(rng.choice([3, 12, 25]))) for i in range(20)]
    frame = spark.createDataFrame([(*d, "clash", 1) for d in docs], "doc_id bigint, text string, Items string, `a b` int")
    listed = spark.createDataFrame(items, "item_id bigint, text string")
    expected = by_repr(plain_hits(docs, items, 4))
    assert by_repr(hits(frame, listed, size=4)) == expected
    assert by_repr(hits(frame, listed, size=4, block=15)) == expected  # several passes


def test_hits_edge_cases(spark):
    passage = " ".join(f"w{i}" for i in range(30))
    docs = [(1, passage.upper()), (2, passage.replace(" ", "--")), (2, passage.replace(" ", "--")), (3, " ".join(passage.split()[:9])), (4, "filler " * 100_000 + passage), (5, None), (6, "")]
    items = [(9, passage), (10, passage), (11, "?!"), (12, None), (13, "filler w0")]
    frame, listed = spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string")
    assert by_repr(hits(frame, listed)) == by_repr(plain_hits(docs, items, 10))
    assert all(r[2:] == ([], []) for r in hits(frame, listed.limit(0))) and hits(frame.limit(0), listed) == []


def test_op13_against_brute_force(spark):
    folder = "/root/testdata/sf0.01"
    docs, items = (spark.read.parquet(f"{folder}/{t}.parquet").select(k, "text").collect() for t, k in (("documents", "doc_id"), ("benchmark", "item_id")))
    expected = [(d, n, sum(b - a for a, b in spans), len(i), digest(",".join(i)), bool(spans)) for d, n, spans, i in plain_hits(docs, items, 10)]
    got = [tuple(r) for r in queries.op13_benchmark_hits(spark, folder).collect()]
    assert by_repr(got) == by_repr(expected) and sum(r[-1] for r in got) > 10
