"""Mix sources to target weights by a low-discrepancy schedule, in DataFrame operations only.

Targets: every source has a weight and a cap; the wanted total is shared by weight, and what a capped source
cannot take is shared again among the others until none is above its cap.

Schedule: slot ``k`` of the mix has the golden-ratio point ``frac((k + 1) / phi)``. Laid on the sources'
cumulative targets it names a source, so any run of slots has each source in its share. The slot's rank
among its source's slots names the block of equally many tokens (here: words) that it takes from the
source's shuffled stream, which starts anew when it is used up. A closing slot takes what the rounding of
the slots leaves of a target, and a slot that passes the target is cut there. The slots are the order of the
mix: a document stands where the first slot that takes from it does.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.session import discard, materialise

#: Fraction of the golden ratio, and what a run of slots adds to it modulo 1.
RUN = 1 << 20
_RATIO = (Decimal(5).sqrt() - 1) / 2
GOLDEN, GOLDEN_RUN = float(_RATIO), float(_RATIO * RUN % 1)
#: Words that a slot takes.
BLOCK = 256
#: Rows that a window sorts together; longer lists are ranked in pieces whose counts are summed first.
PIECE = 1_000
WHITE = "\t\n\x0b\x0c\r"


def words_of(text: str = "text"):
    """Array of the runs of anything but space and U+0009 to U+000D."""
    spaced = F.translate(F.coalesce(F.col(text), F.lit("")), WHITE, " " * len(WHITE))
    return F.array_remove(F.split(spaced, " "), "")


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = (5, 2, 1), share: float = 1.5, repeats: float = 2.0) -> DataFrame:
    """``weight`` and ``target`` added to a table with ``source, source_size`` and one row per source.

    Weights repeat over the sources in code-point order, the missing source last. The targets sum to ``share``
    times all sizes and none exceeds ``repeats`` times its source's size. The windows run over one row
    per source.
    """
    if share > repeats:
        raise ValueError("share cannot exceed repeats")
    number = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    listed = F.array(*[F.lit(float(w)) for w in weights])
    weighed = sizes.withColumn("weight", F.element_at(listed, (number % len(weights) + 1).cast("int")))
    cap = F.col("source_size") * F.lit(float(repeats))
    by_need = Window.orderBy(cap / F.col("weight"), F.col("source").asc_nulls_last())
    whole = Window.partitionBy()
    before = F.coalesce(F.sum(cap).over(by_need.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    left = F.sum("weight").over(by_need.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    total = F.sum("source_size").over(whole) * F.lit(float(share))
    leveled = weighed.withColumn("level", (total - before) / left)
    # sources whose cap is below the level that they would have to share are full; the first other one has the level
    free = F.min(F.when(cap / F.col("weight") >= F.col("level"), F.struct((cap / F.col("weight")).alias("need"), "level"))).over(whole)
    target = F.least(cap, F.col("weight") * free["level"])
    return leveled.withColumn("target", F.coalesce(target, cap)).drop("level")


def ranked(rows: DataFrame, key: str, piece, order: list, measure, name: str) -> DataFrame:
    """Running sum of ``measure`` before each row of its key, as column ``name``.

    ``piece`` is a column whose order agrees with ``order``; windows sort one piece of one key, and sums of
    whole pieces are carried over, so a key with a third of all rows is many tasks.
    """
    cut = rows.withColumn("_piece", piece)
    sums = cut.groupBy(key, "_piece").agg(F.sum(measure).alias("_sum"))
    before = Window.partitionBy(key).orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    carried = sums.select(F.col(key).alias("_key"), F.col("_piece").alias("_of"), F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_carry"))
    inside = Window.partitionBy(key, "_piece").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    local = cut.withColumn("_local", F.coalesce(F.sum(measure).over(inside), F.lit(0)))
    joined = local.join(carried, F.col(key).eqNullSafe(F.col("_key")) & (F.col("_piece") == F.col("_of")))
    return joined.withColumn(name, (F.col("_local") + F.col("_carry")).cast("bigint")).drop("_piece", "_key", "_of", "_carry", "_local")


def slot_schedule(targets: DataFrame, block: int = BLOCK) -> DataFrame:
    """``(source_no, slot, block_no, begin, end)``: the mix in order, each slot with its part of a source's stream.

    ``targets`` has ``source_no`` and ``quota`` (whole tokens). A source has as many cells of the unit interval
    as its quota's share, so points join sources by an equi join on the cell. The rows of a source cover
    its quota once: slots behind it are void, and a closing slot (numbered behind all others) has the
    blocks that no slot came to.
    """
    spark = targets.sparkSession
    row = targets.agg(F.sum("quota"), F.count("*")).first()
    total, sources = row[0] or 0, row[1]
    if not total:
        return spark.createDataFrame([], "source_no int, slot bigint, block_no bigint, begin bigint, end bigint")
    slots, cells = -(-total // block), max(256, 4 * sources)
    high = F.sum("quota").over(Window.orderBy("source_no").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    edges = ((high - F.col("quota")) / F.lit(float(total))).alias("low"), (high / F.lit(float(total))).alias("high")
    bounds = targets.select("source_no", "quota", *edges).filter("quota > 0")
    spans = F.sequence(F.floor(F.col("low") * cells).cast("int"), F.least(F.floor(F.col("high") * cells), F.lit(cells - 1)).cast("int"))
    laid = bounds.withColumn("cell", F.explode(spans))
    # long runs of slots first, so that the product keeps its fraction
    turn = F.floor(F.col("id") / RUN) * F.lit(GOLDEN_RUN) + (F.col("id") % RUN + 1) * F.lit(GOLDEN)
    points = spark.range(slots).select(F.col("id").alias("slot"), (turn - F.floor(turn)).alias("point"))
    points = points.withColumn("cell", F.floor(F.col("point") * cells).cast("int"))
    named = points.join(laid, "cell").filter("point >= low and point < high").select("source_no", "slot", "quota")
    numbered = ranked(named, "source_no", F.floor(F.col("slot") / PIECE), [F.col("slot")], F.lit(1), "block_no")
    numbered = numbered.filter(F.col("block_no") * block < F.col("quota"))
    reached = numbered.groupBy("source_no").agg(F.count("*").alias("reached"))
    rest = bounds.select("source_no", "quota").join(reached, "source_no", "left").withColumn("reached", F.coalesce("reached", F.lit(0)))
    needed = F.ceil(F.col("quota") / block)
    closing = rest.filter(F.col("reached") < needed).select(
        "source_no", "quota", (F.lit(slots) + F.col("source_no")).cast("bigint").alias("slot"), F.explode(F.sequence("reached", needed - 1)).alias("block_no")
    )
    every = numbered.select("source_no", "slot", "block_no", "quota").unionByName(closing)
    begin = F.col("block_no") * block
    return every.select("source_no", "slot", "block_no", begin.alias("begin"), F.least(begin + block, F.col("quota")).alias("end"))


def placements(
    docs: DataFrame, weights: tuple[float, ...] = (5, 2, 1), share: float = 1.5, repeats: int = 2, block: int = BLOCK, row: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """The source streams of ``docs(doc_id, text, source)``, and where the schedule takes from them.

    The streams have a row per document: ``source_no, doc_id, size, source_size, target, begin`` (words of the stream
    before it) and ``row``, if the name of a column that tells rows apart is given. The second table has
    ``source_no, begin, turn, words, first_slot, last_slot`` for each pass over a stream that takes words of a document.
    """
    known = [F.col(row).alias("row")] if row else []
    text_digest = F.coalesce(F.md5(F.col("text").cast("binary")), F.lit(""))
    sized = materialise(
        docs.select(
            F.col("source").alias("own"), "doc_id", F.size(words_of()).cast("bigint").alias("size"),
            F.md5(F.concat_ws(" ", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), text_digest).cast("binary")).alias("draw"), *known,
        ),
        "sizes",
    )
    totals = sized.groupBy(F.col("own").alias("source")).agg(F.sum("size").alias("source_size"), F.count("*").alias("n_docs"))
    number = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())).cast("int")
    targets = source_targets(totals, weights, share, float(repeats)).withColumn("source_no", number)
    targets = materialise(targets.withColumn("quota", F.floor("target")), "targets")

    stream = sized.join(targets, F.col("own").eqNullSafe(F.col("source"))).drop("own", "source", "weight")
    drawn = F.conv(F.substring("draw", 1, 8), 16, 10).cast("bigint") / F.lit(float(1 << 32))
    piece = F.floor(drawn * F.ceil(F.col("n_docs") / PIECE))
    order = [F.col("draw"), F.col("doc_id").asc_nulls_first(), *([F.col("row")] if row else [])]
    stream = materialise(ranked(stream, "source_no", piece, order, F.col("size"), "begin").drop("draw", "n_docs"), "stream")
    discard(sized)

    # a document's places in the stream, once for each pass, and the blocks that they touch
    passes = F.explode(F.sequence(F.lit(0), F.lit(repeats - 1)))
    places = stream.filter("size > 0").select("source_no", "begin", "size", "source_size", "quota", passes.alias("turn"))
    places = places.withColumn("from", F.col("begin") + F.col("turn") * F.col("source_size")).filter(F.col("from") < F.col("quota"))
    places = places.withColumn("to", F.least(F.col("from") + F.col("size"), F.col("quota")))
    touched = F.sequence(F.floor(F.col("from") / block), F.floor((F.col("to") - 1) / block))
    pieces = places.withColumn("block_no", F.explode(touched))
    schedule = slot_schedule(targets, block).withColumnRenamed("begin", "slot_begin").withColumnRenamed("end", "slot_end")
    overlap = F.least("to", "slot_end") - F.greatest("from", "slot_begin")
    met = pieces.join(schedule, ["source_no", "block_no"]).withColumn("words", overlap).filter("words > 0")
    taken = met.groupBy("source_no", "begin", "turn").agg(F.sum("words").alias("words"), F.min("slot").alias("first_slot"), F.max("slot").alias("last_slot"))
    return stream.drop("quota"), taken


def mix(docs: DataFrame, weights: tuple[float, ...] = (5, 2, 1), share: float = 1.5, repeats: int = 2, block: int = BLOCK) -> DataFrame:
    """``(doc_id, size, source_size, target, taken, first_slot, last_slot)`` for every row of ``docs(doc_id, text, source)``.

    ``taken`` counts the words of the document in the mix, repeats included, 0 for a document it leaves
    out; ``first_slot`` and ``last_slot`` are the places of the mix where it is met first and last, null if it is
    left out. A source's stream has its documents in the order of a digest of doc_id and text, so reruns agree; a
    source's taken words sum to its target without the fraction. Null sources are one source. Null and empty
    texts have size 0 and nothing taken. Rows alike in id and text are documents of their own. An empty table stays
    empty. Other columns of ``docs`` are not read.
    """
    stream, passes = placements(docs, weights, share, repeats, block)
    taken = passes.groupBy(F.col("source_no").alias("no"), F.col("begin").alias("at")).agg(
        F.sum("words").alias("taken"), F.min("first_slot").alias("first_slot"), F.max("last_slot").alias("last_slot")
    )
    # places of documents with words are distinct; an empty one shares its place with the next
    same = (F.col("source_no") == F.col("no")) & (F.col("begin") == F.col("at")) & (F.col("size") > 0)
    met = stream.join(taken, same, "left")
    return met.select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("bigint").alias("taken"), "first_slot", "last_slot")


def first_words(text: Column, count: Column) -> Column:
    """A text up to the end of its ``count``-th word, spaces and line ends kept."""
    white = f"[ {WHITE}]+"
    words = F.filter(F.split(text, white), lambda w: w != "")
    gaps = F.regexp_extract_all(text, F.lit(white), F.lit(0))
    leading = F.when(text.rlike(f"\\A{white}"), 1).otherwise(0)

    def length(parts: Column, number: Column) -> Column:
        return F.aggregate(F.slice(parts, F.lit(1), number.cast("int")), F.lit(0), lambda n, part: n + F.length(part))

    return F.substring(text, F.lit(1), length(words, count) + length(gaps, F.greatest(count - 1 + leading, F.lit(0))))


def mixed_texts(docs: DataFrame, **settings) -> DataFrame:
    """The documents that the mix takes, in the order of its slots: a row for each pass that takes words of one.

    A document of which a pass takes a part is cut behind the last word taken, its spaces and line ends kept, and
    marked in the added column ``cut``. ``docs`` must give its rows in the same order each time it is read (a table of files
    does), because rows are told apart by their place.
    """
    placed = docs.withColumn("_row", F.monotonically_increasing_id())
    stream, passes = placements(placed, row="_row", **settings)
    where = stream.filter("size > 0").select("source_no", "begin", F.col("row").alias("_row"), "size")
    taken = where.join(passes, ["source_no", "begin"]).select("_row", "size", "words", "first_slot", "source_no", "begin", "turn")
    rows = placed.join(taken, "_row")
    ordered = rows.orderBy("first_slot", "source_no", "turn", "begin").withColumn("cut", F.col("words") < F.col("size"))
    text = F.when(F.col("cut"), first_words(F.col("text"), F.col("words"))).otherwise(F.col("text"))
    return ordered.withColumn("text", text).select(*docs.columns, "cut")
