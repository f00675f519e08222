"""Secret scans: patterns, and character Markov models compared by log-likelihood ratio.

Everything is DataFrame expressions. A pattern's spans come from the lengths of its matches and of the text
between them. Two first-order Markov models over characters are counted from labelled samples: random
strings (values that the patterns found, and digests of document numbers in the usual spellings) and
ordinary identifiers (words of texts outside the patterns' spans). A long run of key characters is a secret
when the logarithm of its likelihood ratio, its first character included, reaches ``log_odds``.
"""

from __future__ import annotations

import json
import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.sampling import draw_of, least_drawn
from millrace.session import materialise

# fixed values: the kinds in their order, and their patterns
KINDS = ("assign", "access", "hex", "model")
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}"
ALPHABET = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_=-"
#: States of the models: before the first character, each character of the alphabet, any other.
STATES = len(ALPHABET) + 2

SPAN = "array<struct<start:int,kind_no:int,end:int,kind:string,value:string,first_byte:int,end_byte:int>>"
#: Elements of an array that are combined one by one.
BLOCK = 512


def _run(least: int) -> str:
    key = "[A-Za-z0-9+/_=-]"
    return f"(?<!{key}){key}{{{least},}}+"


def named(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, also where functions over elements ask for it again and again."""
    return F.element_at(F.transform(F.array(value), use), 1)


def before(values: Column, zero: Column, combine: Callable[[Column, Column], Column]) -> Column:
    """For each element of an array, all elements before it combined.

    Arrays are copied when something is appended, so long ones are combined in blocks, and the blocks in turn:
    the work grows with the length times ``BLOCK``, not with its square.
    """

    def cut(whole: Column) -> Column:
        blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(whole) - 1) / BLOCK).cast("int")), lambda k: F.slice(whole, k * BLOCK + 1, BLOCK))
        return F.when(F.size(whole) > 0, blocks).otherwise(F.slice(F.array(whole), 1, 0))

    def appended(state: Column, value: Column) -> Column:
        return F.array_append(state, combine(F.element_at(state, -1), value))

    scanned = F.transform(named(values, cut), lambda block: F.aggregate(block, F.array(zero), appended))

    def joined(parts: Column) -> Column:
        first = F.aggregate(parts, F.array(zero), lambda state, part: appended(state, F.element_at(part, -1)))
        each = F.zip_with(parts, F.slice(first, F.lit(1), F.size(parts)), lambda part, own: F.transform(F.slice(part, F.lit(1), F.size(part) - 1), lambda x: combine(own, x)))
        return F.flatten(each)

    return named(scanned, joined)


def pattern_spans(text: Column, pattern: str, kind: str, group: int = 0, least: int = 0) -> Column:
    """Leftmost non-overlapping matches as spans in code points and bytes; those whose group is shorter than ``least`` go."""

    def matches(of: int) -> Column:
        return F.regexp_extract_all(text, F.lit(pattern), F.lit(of))

    def located(found: Column) -> Column:
        whole = found["whole"]
        gaps = F.slice(found["pieces"], F.lit(1), F.size(whole))

        def begins(length: Callable[[Column], Column]) -> Column:
            """Where each gap begins."""
            return before(F.zip_with(gaps, whole, lambda gap, match: length(gap) + length(match)), F.lit(0), lambda a, b: a + b)

        return F.transform(
            F.arrays_zip(
                gaps.alias("gap"), whole.alias("whole"), (found["value"] if group else whole).alias("value"), begins(F.length).alias("at"), begins(F.octet_length).alias("byte")
            ),
            span,
        )

    def span(part: Column) -> Column:
        start, first = part["at"] + F.length(part["gap"]), part["byte"] + F.octet_length(part["gap"])
        return F.struct(
            start.alias("start"), F.lit(KINDS.index(kind)).alias("kind_no"), (start + F.length(part["whole"])).alias("end"), F.lit(kind).alias("kind"),
            part["value"].alias("value"), first.alias("first_byte"), (first + F.octet_length(part["whole"])).alias("end_byte"),
        )

    pieces = F.struct(F.split(text, pattern, -1).alias("pieces"), matches(0).alias("whole"), *([matches(group).alias("value")] if group else []))
    found = F.filter(named(pieces, located), lambda s: F.length(s["value"]) >= least)
    return F.when(text.rlike(pattern), found).otherwise(F.array().cast(SPAN))


def base_spans(text: Column) -> Column:
    """Spans of the three pattern kinds, by start, then kind."""
    found = pattern_spans(text, ASSIGN, "assign", 2, 8), pattern_spans(text, ACCESS, "access"), pattern_spans(text, HEX, "hex")
    return F.sort_array(F.concat(*found))


def _state(char: Column) -> Column:
    at = F.instr(F.lit(ALPHABET), char)
    return F.when(at > 0, at).otherwise(STATES - 1)


def steps(word: Column) -> Column:
    """Numbers of the transitions that a word makes, from the start state on."""
    states = F.transform(F.filter(F.split(word, ""), lambda c: c != ""), _state)
    before = F.concat(F.array(F.lit(0)), states)
    return F.zip_with(F.slice(before, 1, F.size(states)), states, lambda a, b: a * STATES + b)


def labelled_samples(docs: DataFrame, sample: int = 2000) -> DataFrame:
    """``(word, random)`` from at most ``sample`` documents with base spans and ``sample`` of all documents.

    The documents with the least md5(doc_id) are taken, so reruns agree. Each drawn document also gives its
    number's digests as random strings: in hexadecimal, lower and upper case, in base 64, and in letters and
    digits of either case.
    """
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), draw_of().alias("draw"))
    # only ids are sorted and gathered; at most twice ``sample`` of them meet the texts again
    holds = F.col("text").rlike(f"{ASSIGN}|{ACCESS}|{HEX}")
    ids = materialise(rows.select("draw", "doc_id", holds.alias("holds")), "secret-ids")

    def least(some: DataFrame, name: str) -> DataFrame:
        return least_drawn(some.select("draw", "doc_id"), "draw", ["draw", "doc_id"], sample).select("draw", F.lit(name).alias("name"))

    wanted = least(ids, "drawn").union(least(ids.filter("holds"), "holding")).distinct()
    named = wanted.groupBy("draw").agg(F.collect_set("name").alias("names"))
    # the texts of a repeated id are all taken, so holding ones are told from the others again
    taken = materialise(rows.join(F.broadcast(named), "draw"), "secret-texts")
    drawn = taken.filter(F.array_contains("names", "drawn"))
    holding = taken.filter(F.array_contains("names", "holding") & holds)
    found = holding.select(F.explode(base_spans(F.col("text"))["value"]).alias("word"))
    digest = F.sha2(F.col("draw"), 256)
    sixty_four = F.base64(F.unhex(digest))
    letters = F.regexp_replace(sixty_four, "[^A-Za-z0-9]", "")
    spellings = [F.substring(digest, 1, 40), F.upper(F.substring(digest, 1, 40)), sixty_four, F.substring(F.upper(letters), 1, 20), F.substring(F.lower(letters), 1, 20)]
    made = drawn.select(F.explode(F.array(*spellings)).alias("word"))
    plain = F.regexp_replace(F.regexp_replace(F.regexp_replace("text", ASSIGN, " "), ACCESS, " "), HEX, " ")
    ordinary = drawn.select(F.explode(F.regexp_extract_all(plain, F.lit(_run(4)), F.lit(0))).alias("word"))
    return found.union(made).withColumn("random", F.lit(1)).union(ordinary.withColumn("random", F.lit(0)))


def fit(samples: DataFrame, smoothing: float = 0.5) -> list[float]:
    """Log-likelihood ratio of every transition, random strings against identifiers; states squared numbers."""
    counted = samples.select("random", F.explode(steps(F.col("word"))).alias("step")).groupBy("random", "step").count()
    counts = [[smoothing] * (STATES * STATES) for _ in range(2)]
    for row in counted.collect():  # at most two rows for each transition of the alphabet
        counts[row["random"]][row["step"]] += row["count"]
    logs = []
    for own in counts:
        rows = [sum(own[a * STATES : (a + 1) * STATES]) for a in range(STATES)]
        logs.append([math.log(c / rows[i // STATES]) for i, c in enumerate(own)])
    return [r - o for r, o in zip(logs[1], logs[0], strict=True)]


def score(word: Column, ratios: Column) -> Column:
    """Logarithm of the likelihood ratio of a word."""
    return F.aggregate(steps(word), F.lit(0.0), lambda total, step: total + F.element_at(ratios, step + 1))


def untouched(runs: Column, others: Column) -> Column:
    """The runs that no other span overlaps.

    Both are laid out by where a run ends and another span begins, runs first; a run is free when no span
    before it in this order ends behind the run's start.
    """
    events = F.sort_array(F.concat(
        F.transform(runs, lambda r: F.struct(r["end"].alias("at"), F.lit(0).alias("other"), F.lit(0).alias("reach"), r.alias("run"))),
        F.transform(others, lambda b: F.struct(b["start"].alias("at"), F.lit(1).alias("other"), b["end"].alias("reach"), b.alias("run"))),
    ))

    def free(laid: Column) -> Column:
        reached = before(F.transform(laid, lambda e: e["reach"]), F.lit(0), F.greatest)
        kept = F.filter(F.arrays_zip(laid.alias("event"), reached.alias("reached")), lambda e: (e["event"]["other"] == 0) & (e["reached"] <= e["event"]["run"]["start"]))
        return F.transform(kept, lambda e: e["event"]["run"])

    return F.when((F.size(runs) > 0) & (F.size(others) > 0), named(events, free)).otherwise(runs)


def secret_spans(docs: DataFrame, ratios: list[float], least: int = 16, log_odds: float = 12.0) -> DataFrame:
    """``docs`` with ``base`` and ``spans`` added: pattern spans, and those with the models' spans.

    A run of at least ``least`` key characters that touches no pattern span is a span of kind ``model`` when
    its score reaches ``log_odds`` (the prior odds against a secret, as a logarithm). Spans are code
    points, end exclusive, by start, then kind. Null and empty texts have none. Columns of ``docs`` named
    ``base`` or ``spans`` are replaced.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    found = docs.drop("base", "spans").withColumn("base", base_spans(text))
    table = F.from_json(F.lit(json.dumps(ratios)), "array<double>")
    runs = pattern_spans(text, _run(least), "model")
    added = F.filter(named(runs, lambda some: untouched(some, F.col("base"))), lambda r: score(r["value"], table) >= log_odds)
    return found.withColumn("spans", F.sort_array(F.concat("base", added)))


def written(spans: str) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    return F.array_join(F.transform(F.col(spans), lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def counted(kind: str, spans: str = "base") -> Column:
    return F.size(F.filter(F.col(spans), lambda s: s["kind"] == kind)).cast("bigint")


def redacted(text: Column, spans: Column, mark: str = "[SECRET]") -> Column:
    """The text with every stretch that spans cover replaced by one mark; a null text stays null.

    The pieces between the spans are taken by their bytes, which does not read the text from its beginning.
    """
    reached = before(F.transform(spans, lambda s: s["end_byte"]), F.lit(0), F.greatest)
    last = F.array_max(F.transform(spans, lambda s: s["end_byte"]))

    def rest(data: Column) -> Column:
        def piece(part: Column) -> Column:
            gap = F.substring(data, part["reached"] + 1, part["span"]["first_byte"] - part["reached"]).cast("string")
            return F.when(part["span"]["first_byte"] >= part["reached"], F.concat(gap, F.lit(mark))).otherwise(F.lit(""))

        pieces = F.transform(F.arrays_zip(spans.alias("span"), reached.alias("reached")), piece)
        return F.concat(F.array_join(pieces, ""), F.substring(data, last + 1, F.octet_length(data)).cast("string"))

    return F.when(F.size(spans) > 0, named(text.cast("binary"), rest)).otherwise(text)
