"""N-gram Jaccard join by vertical partitioning.

A document is the set of its word shingles. The join finds the classes of documents that are connected
by links of at least the wanted Jaccard similarity, without listing all pairs of a group of copies:

1. One pass over the texts hashes the shingles, cuts the space of n-grams into fragments and sends each
   fragment's part of many documents as one packed block. A fragment knows which n-grams at least two
   different sets hold; an n-gram that a block already shares is sent there once, not once per document.
2. A set of which less than the wanted part is shared with any other set can have no link. The others
   (``survivors``) are put into the global order of n-grams, rarest first, and that order is cut into
   fragments (:func:`fragments_of`) at its quantiles.
3. Candidates share an n-gram among the first of both sets and pass the length and position bounds.
   Overlaps of a candidate pair are counted for each fragment apart and summed (:func:`summed_overlaps`).
4. Star rounds compare each n-gram's documents with the most central one only and merge what links; the
   last round compares every candidate pair that is still in two components, so no link is lost.

N-grams are 64-bit hashes of which a fragment's members keep 48 bits beside the fragment number. Sets
are told apart by 64 bits of a digest of all members.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.components import component_edges
from millrace.llm.words import serving, shingle_hashes, split_words, word_hashes
from millrace.session import discard, input_bytes, materialise

LOW = np.uint64((1 << 48) - 1)
#: Shingles of one packed block; more documents start another block.
BLOCK = 1_000_000
#: Fragments of the n-gram space that an n-gram's id names; beyond, a fragment is cut by further bits of the hash.
FRAGMENTS = 1 << 15
#: Bytes of input for each part that a task holds.
PART_BYTES = 128 << 20
DOCS, ALONE, KNOWN, SHARED = range(4)

_BLOCKS = T.StructType(
    [
        T.StructField("part", T.IntegerType()),
        T.StructField("kind", T.IntegerType()),
        T.StructField("doc_ids", T.ArrayType(T.LongType())),
        T.StructField("sets", T.BinaryType()),
        T.StructField("counts", T.BinaryType()),
        T.StructField("low", T.BinaryType()),
        T.StructField("high", T.BinaryType()),
    ]
)
_BLOCKS_ARROW = pa.schema(
    [
        ("part", pa.int32()), ("kind", pa.int32()), ("doc_ids", pa.list_(pa.int64())),
        ("sets", pa.binary()), ("counts", pa.binary()), ("low", pa.binary()), ("high", pa.binary()),
    ]
)
_MEMBERS = "doc_id bigint, set_id bigint, n int, text_key bigint, grams array<bigint>"
_MEMBERS_ARROW = pa.schema([("doc_id", pa.int64()), ("set_id", pa.int64()), ("n", pa.int32()), ("text_key", pa.int64()), ("grams", pa.list_(pa.int64()))])


def gram_ids(text: bytes | None, fragments: int, width: int) -> np.ndarray:
    """Sorted distinct n-gram ids: the fragment number above 48 bits of hash."""
    hashes = shingle_hashes(word_hashes(split_words(text.lower() if text else None)), width)
    fragment = (hashes >> np.uint64(48)) * np.uint64(fragments) >> np.uint64(16)
    return np.unique((fragment << np.uint64(48)) | (hashes & LOW))


class _Block:
    """Documents gathered for one set of block rows."""

    def __init__(self, fragments: int, cuts: int = 1):
        self.fragments, self.cuts = fragments, cuts
        self.doc_ids: list = []
        self.doc_sets: list[int] = []
        self.doc_sizes: list[int] = []
        self.doc_keys: list[int] = []
        self.sets: dict[int, np.ndarray] = {}
        self.total = 0

    def add(self, doc_id, grams: np.ndarray, text_key: int | None = None) -> None:
        key = int.from_bytes(hashlib.md5(grams.tobytes()).digest()[:8], "little", signed=True)
        self.doc_ids.append(doc_id)
        self.doc_sets.append(key)
        self.doc_sizes.append(len(grams))
        if text_key is not None:
            self.doc_keys.append(text_key)
        if key not in self.sets:
            self.sets[key] = grams
            self.total += len(grams)

    def rows(self) -> pa.RecordBatch:
        out: list[tuple] = []
        doc_sets, sizes, text_keys = np.array(self.doc_sets, np.int64), np.array(self.doc_sizes, np.int32), np.array(self.doc_keys, np.int64)
        parts = np.uint64(self.fragments * self.cuts)
        home = (doc_sets.view(np.uint64) % parts).astype(np.int32)
        for part in np.unique(home).tolist():
            here = np.flatnonzero(home == part)
            out.append((part, DOCS, [self.doc_ids[i] for i in here], doc_sets[here].tobytes(), sizes[here].tobytes(), text_keys[here].tobytes() if len(text_keys) else None, None))
        keys = np.array(list(self.sets), np.int64)
        grams = np.concatenate([*self.sets.values(), np.empty(0, np.uint64)])
        owner = np.repeat(np.arange(len(keys)), [len(x) for x in self.sets.values()])
        order = np.argsort(grams, kind="stable")
        same = grams[order][1:] == grams[order][:-1]
        twice = np.zeros(len(grams), bool)
        twice[order[1:][same]] = True
        twice[order[:-1][same]] = True

        def packed(kind: int, parts: np.ndarray, who: np.ndarray | None, what: np.ndarray) -> None:
            if not len(parts):
                return
            by = np.argsort(parts, kind="stable")
            parts, what = parts[by], what[by]
            cuts = np.flatnonzero(np.r_[True, parts[1:] != parts[:-1]])
            for a, b in zip(cuts, np.r_[cuts[1:], len(parts)], strict=True):
                part, piece, sets, counts = int(parts[a]), what[a:b], None, None
                if who is not None:
                    own = who[by[a:b]]
                    first = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
                    sets, counts = keys[own[first]].tobytes(), np.diff(np.r_[first, len(own)]).astype(np.int32).tobytes()
                if kind == SHARED:
                    out.append((part, kind, None, sets, counts, piece.tobytes(), None))
                else:
                    low, high = piece.astype(np.uint32), ((piece & LOW) >> np.uint64(32)).astype(np.uint16)
                    out.append((part, kind, None, sets, counts, low.tobytes(), high.tobytes()))

        packed(ALONE, part_of(grams[~twice], self.cuts), owner[~twice], grams[~twice])
        known = np.unique(grams[twice])
        packed(KNOWN, part_of(known, self.cuts), None, known)
        own = owner[twice]
        packed(SHARED, (keys.view(np.uint64)[own] % parts).astype(np.int32), own, grams[twice])
        columns = zip(*out, strict=True) if out else [[]] * len(_BLOCKS_ARROW)
        return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(columns, _BLOCKS_ARROW, strict=True)], schema=_BLOCKS_ARROW)


def part_of(grams: np.ndarray, cuts: int) -> np.ndarray:
    """The part of each n-gram: its fragment, cut by bits of the hash below the fragment's."""
    parts = (grams >> np.uint64(48)).astype(np.int32)
    return parts if cuts == 1 else parts * cuts + ((grams & LOW) % np.uint64(cuts)).astype(np.int32)


def _cut_into_blocks(fragments: int, cuts: int, width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = _Block(fragments, cuts)
        for batch in batches:
            texts = batch.column("text").cast(pa.binary())
            text_keys = batch.column("text_key").to_pylist() if "text_key" in batch.schema.names else [None] * len(texts)
            for doc_id, text, text_key in zip(batch.column("doc_id").to_pylist(), texts, text_keys, strict=True):
                block.add(doc_id, gram_ids(text.as_py(), fragments, width), text_key)
                if block.total >= BLOCK or len(block.doc_ids) >= BLOCK // 10:
                    yield block.rows()
                    block = _Block(fragments, cuts)
        yield block.rows()

    return serving("ngram join", run)


def _by_set(sets: np.ndarray, grams: np.ndarray) -> pa.RecordBatch:
    """A row for each set, with its grams."""
    order = np.argsort(sets, kind="stable")
    sets, grams = sets[order], grams[order]
    first = np.flatnonzero(np.r_[True, sets[1:] != sets[:-1]]) if len(sets) else np.empty(0, int)
    lists = pa.ListArray.from_arrays(pa.array(np.r_[first, len(sets)].astype(np.int32)), pa.array(grams.view(np.int64)))
    nothing = [pa.nulls(len(first), pa.int64()), pa.array(sets[first]), pa.nulls(len(first), pa.int32()), pa.nulls(len(first), pa.int64()), lists]
    return pa.RecordBatch.from_arrays(nothing, schema=_MEMBERS_ARROW)


def _once(sets: np.ndarray, grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct pairs, by gram, then set."""
    order = np.lexsort((sets, grams))
    sets, grams = sets[order], grams[order]
    keep = np.r_[True, (sets[1:] != sets[:-1]) | (grams[1:] != grams[:-1])][: len(sets)]
    return sets[keep], grams[keep]


def _find_shared(cuts: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Within each part: the members of sets that a second set has too; document rows pass through."""
    alone: dict[int, list] = {}
    known: dict[int, list] = {}
    shared: list = []
    for batch in batches:
        for row in batch.to_pylist():
            sets = np.frombuffer(row["sets"], np.int64) if row["sets"] is not None else None
            counts = np.frombuffer(row["counts"], np.int32) if row["counts"] is not None else None
            if row["kind"] == DOCS:
                ids = pa.array(row["doc_ids"], pa.int64())
                text_keys = pa.array(np.frombuffer(row["low"], np.int64)) if row["low"] is not None else pa.nulls(len(ids), pa.int64())
                yield pa.RecordBatch.from_arrays([ids, pa.array(sets), pa.array(counts), text_keys, pa.nulls(len(ids), pa.list_(pa.int64()))], schema=_MEMBERS_ARROW)
            elif row["kind"] == SHARED:
                shared.append((np.repeat(sets, counts), np.frombuffer(row["low"], np.uint64)))
                if sum(len(x[0]) for x in shared) > BLOCK:  # what comes twice is made one when the sets are put together
                    yield _by_set(*_once(*(np.concatenate(x) for x in zip(*shared, strict=True))))
                    shared = []
            else:
                low = np.frombuffer(row["low"], np.uint32).astype(np.uint64)
                grams = low | (np.frombuffer(row["high"], np.uint16).astype(np.uint64) << np.uint64(32))
                if row["kind"] == KNOWN:
                    known.setdefault(row["part"], []).append(grams)
                else:
                    alone.setdefault(row["part"], []).append((np.repeat(sets, counts), grams))
    if shared:
        yield _by_set(*_once(*(np.concatenate(x) for x in zip(*shared, strict=True))))
    for part, pieces in alone.items():
        sets, grams = (np.concatenate(x) for x in zip(*pieces, strict=True))
        pieces.clear()
        marked = np.unique(np.concatenate([*known.get(part, []), np.empty(0, np.uint64)]))
        order = np.argsort(grams, kind="stable")
        sets, grams = sets[order], grams[order]
        again = grams[1:] == grams[:-1]
        several = np.r_[again, False] | np.r_[False, again][: len(grams)] if len(grams) else again
        single_sets, single = sets[~several], grams[~several]
        several_sets, several_grams = _once(sets[several], grams[several])
        again = several_grams[1:] == several_grams[:-1]
        mine = (np.r_[again, False] | np.r_[False, again])[: len(several_grams)]
        found = [(several_sets[mine], several_grams[mine])]
        for s, g in ((single_sets, single), (several_sets[~mine], several_grams[~mine])):
            if len(marked) and len(g):
                at = np.minimum(np.searchsorted(marked, g), len(marked) - 1)
                found.append((s[marked[at] == g], g[marked[at] == g]))
        sets, grams = (np.concatenate(x) for x in zip(*found, strict=True))
        yield _by_set(sets, grams | (np.uint64(part // cuts) << np.uint64(48)))


def least_overlap(n, m, percent: int):
    """Least overlap of sets of n and m members that makes the wanted similarity."""
    return F.ceil((n + m) * F.lit(percent) / F.lit(100 + percent))


def fragments_of(grams: DataFrame, fragments: int) -> list[float]:
    """Pivots that cut the global order (by frequency, then id) into parts of about equal size."""
    shares = [i / fragments for i in range(1, fragments)]
    row = grams.agg(F.percentile_approx("place", shares, 10_000)).first()
    return sorted(set(row[0] or []))


def summed_overlaps(pairs: DataFrame, segments: DataFrame) -> DataFrame:
    """``(a, b, overlap)``: common n-grams of each pair, counted per fragment and summed."""
    left = segments.select(F.col("set_id").alias("a"), "fragment", F.col("grams").alias("left"))
    right = segments.select(F.col("set_id").alias("b"), "fragment", F.col("grams").alias("right"))
    met = pairs.select("a", "b").join(left, "a").join(right, ["b", "fragment"])
    return met.groupBy("a", "b").agg(F.sum(F.size(F.array_intersect("left", "right"))).alias("overlap"))


def ngram_join(docs: DataFrame, percent: int = 75, width: int = 5, fragments: int = 8, star_rounds: int = 2, cell: int = 500, keyed: bool = False) -> DataFrame:
    """``(doc_id, n_shingles, component_id)`` for every row of ``docs(doc_id, text)``.

    Two documents link when ``100 * |A & B| >= percent * |A | B|`` over their sets of ``width``-word
    shingles of the text with A-Z in lower case; a shorter text is one shingle. ``component_id`` is the
    smallest doc_id that links reach. Null and empty texts, and texts of white space, have no shingles
    and are their own component. Equal sets always link. Repeated rows come back as often as they are
    given; rows without doc_id keep their set's component. Other columns of ``docs`` are not read.

    ``keyed`` adds ``text_key``, the xxhash64 of the row's text, and ``class_id``, which names the class of
    linked sets whatever the ids of its rows; all texts without shingles have one class_id.

    ``cell`` bounds the documents of one n-gram that a task compares at a time in the last round.
    """
    spark = docs.sparkSession
    wanted = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-(input_bytes(docs.select("text")) or 0) // PART_BYTES))
    pieces = min(wanted, FRAGMENTS)
    cuts = -(-wanted // pieces)
    parts = pieces * cuts
    text_key = [F.xxhash64("text").alias("text_key")] if keyed else []
    blocks = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", *text_key).mapInArrow(_cut_into_blocks(pieces, cuts, width), _BLOCKS)
    find = serving("ngram join", partial(_find_shared, cuts))
    members = materialise(blocks.repartitionById(parts, F.col("part")).mapInArrow(find, _MEMBERS), "grams")
    rows = materialise(members.filter("n is not null").select("doc_id", F.col("n").cast("bigint").alias("n_shingles"), "set_id", "text_key"), "documents")

    enough = F.size("grams") * 100 >= F.col("n") * percent
    sets = members.groupBy("set_id").agg(
        F.min("doc_id").alias("least_id"), F.max("n").alias("n"), F.array_distinct(F.flatten(F.collect_list("grams"))).alias("grams")
    )
    sets = materialise(sets.withColumn("grams", F.when((F.col("n") > 0) & enough, F.col("grams"))), "sets")
    facts = materialise(sets.select("set_id", "n", "least_id", F.col("grams").isNotNull().alias("survives")), "set-facts")
    discard(members)
    survivors = facts.filter("survives").select("set_id", "n")

    flat = sets.filter("grams is not null").select("set_id", "n", F.explode("grams").alias("gram"))
    frequency = flat.groupBy("gram").agg(F.count("*").alias("df")).filter("df > 1")
    # monotone in (df, gram); equal n-grams have equal places
    place = F.col("df") + (F.col("gram") / F.lit(float(1 << 63)) + 1) / 2
    ranked = materialise(flat.join(frequency, "gram").withColumn("place", place), "ranked")
    discard(sets)
    pivots = fragments_of(ranked, fragments)
    number = sum(((F.col("place") >= p).cast("int") for p in pivots), F.lit(0))
    segments = materialise(ranked.groupBy("set_id", number.alias("fragment")).agg(F.collect_list("gram").alias("grams")), "segments")

    ordered = ranked.groupBy("set_id").agg(
        F.max("n").alias("n"), (F.sum("df") / F.max("n")).alias("centre"), F.sort_array(F.collect_list(F.struct("df", "gram"))).alias("order")
    )
    ordered = ordered.filter(F.size("order") * 100 >= F.col("n") * percent)
    # members that no other survivor has are the rarest and come first, so later ones start behind them
    prefix = ordered.select("set_id", "n", "centre", F.posexplode("order").alias("at", "entry"), (F.col("n") - F.size("order")).alias("ahead"))
    prefix = prefix.select("set_id", "n", "centre", (F.col("at") + F.col("ahead")).alias("at"), F.col("entry.gram").alias("gram"))
    prefix = materialise(prefix.filter(F.col("at") <= F.col("n") - F.ceil(F.col("n") * percent / 100)), "prefix")
    discard(ranked)

    labels = materialise(survivors.select("set_id", F.col("set_id").alias("label")), "labels")

    def admissible(one: str, two: str):
        n, m = F.col(f"{one}.n"), F.col(f"{two}.n")
        rest = F.least(n - F.col(f"{one}.at"), m - F.col(f"{two}.at"))
        sizes = (F.least(n, m) * 100 >= F.greatest(n, m) * percent) & (rest >= least_overlap(n, m, percent))
        return sizes & (F.col(f"{one}.label") != F.col(f"{two}.label"))

    def pairs_of(joined: DataFrame) -> DataFrame:
        ids = F.col("x.set_id"), F.col("y.set_id")
        return joined.select(F.least(*ids).alias("a"), F.greatest(*ids).alias("b")).distinct()

    def merged(pairs: DataFrame) -> DataFrame:
        counted = summed_overlaps(pairs, segments)
        for side in "ab":
            counted = counted.join(survivors.select(F.col("set_id").alias(side), F.col("n").alias(f"n_{side}")), side)
        links = counted.filter(F.col("overlap") * 100 >= (F.col("n_a") + F.col("n_b") - F.col("overlap")) * percent)
        for side, end in (("a", "u"), ("b", "v")):
            links = links.join(labels.select(F.col("set_id").alias(side), F.col("label").alias(end)), side)
        found, edges = component_edges(links.select("u", "v"))
        moved = found.select(F.col("node").alias("label"), F.col("label").alias("new"))
        after = materialise(labels.join(moved, "label", "left").select("set_id", F.coalesce("new", "label").alias("label")), "labels")
        discard(labels, edges)
        return after

    for turn in range(star_rounds):
        entries = prefix.join(labels, "set_id")
        weight = F.col("centre") if turn == 0 else F.xxhash64("set_id", F.lit(turn)).cast("double")
        hub = entries.groupBy("gram").agg(
            F.max(F.struct(weight.alias("weight"), "set_id", "n", "at", "label")).alias("hub"), F.min("label").alias("low"), F.max("label").alias("high")
        )
        hub = hub.filter("low <> high").select("gram", "hub.*")
        labels = merged(pairs_of(entries.alias("x").join(hub.alias("y"), "gram").filter(admissible("x", "y"))))

    entries = prefix.join(labels, "set_id")
    mixed = entries.groupBy("gram").agg(F.min("label").alias("low"), F.max("label").alias("high"), F.count("*").alias("size"))
    mixed = mixed.filter("low <> high").select("gram", F.ceil(F.col("size") / cell).cast("int").alias("cells"))
    placed = entries.join(mixed, "gram").withColumn("own", F.pmod(F.xxhash64("set_id"), F.col("cells")).cast("int"))
    spread = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("cells") - 1)))
    spread = spread.select("*", F.least("own", "other").alias("row"), F.greatest("own", "other").alias("column"))
    met = spread.alias("x").join(spread.alias("y"), ["gram", "row", "column"])
    # within a mixed cell only pairs across its two parts: pairs of one part meet in that part's own cell
    across = (F.col("x.own") != F.col("y.own")) | (F.col("row") == F.col("column"))
    labels = merged(pairs_of(met.filter((F.col("x.set_id") < F.col("y.set_id")) & across & admissible("x", "y"))))

    discard(segments, prefix)
    classes = facts.select("set_id", "least_id").join(labels, "set_id", "left").withColumn("label", F.coalesce("label", "set_id"))
    least = classes.groupBy("label").agg(F.min("least_id").alias("component_id"))
    named = classes.join(least, "label").select("set_id", "component_id", F.col("label").alias("class_id"))
    own = F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("component_id"))
    return rows.join(named, "set_id").select("doc_id", "n_shingles", own.alias("component_id"), *(["text_key", "class_id"] if keyed else []))
