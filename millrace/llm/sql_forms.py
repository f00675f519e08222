"""SQL forms (DuckDB) of the queries on mixtures, periodic runs, the Merkle manifest and benchmark passages."""

from __future__ import annotations

from millrace.llm.mixing import BLOCK, GOLDEN, GOLDEN_RUN, RUN

#: Entry n of the table of crc32, from its polynomial.
_CRC_TABLE = """(SELECT list(entry ORDER BY n) FROM (SELECT n,
    list_reduce(list_concat([n], range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(3988292384::BIGINT, c >> 1) ELSE c >> 1 END) AS entry FROM range(256) AS t(n)))"""


def _crc32(number: str) -> str:
    """Unsigned crc32 of a number's decimal digits, with ``crc(entries)`` in scope."""
    digits = f"list_transform(range(length({number}::VARCHAR)), lambda i: ascii(substring({number}::VARCHAR, (i + 1)::INT, 1))::BIGINT)"
    return f"xor(4294967295::BIGINT, list_reduce(list_concat([4294967295::BIGINT], {digits}), lambda c, b: xor(entries[(xor(c, b) & 255) + 1], c >> 8)))"


PERIODIC_RUNS = rf"""
WITH crc AS (SELECT {_CRC_TABLE} AS entries),
split AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^ \t\n\x0b\x0c\r]+') AS words FROM documents),
hashed AS (SELECT r, doc_id, words, len(words) AS n, {_crc32("doc_id")} AS h FROM split, crc),
placed AS (SELECT *, CASE WHEN h % 10 = 0 AND n > 0 THEN (h // 10) % n END AS a FROM hashed),
chosen AS (SELECT *, 1 + (n - a) // (3 + (h // 10) % 8) AS p FROM placed),
planted AS (SELECT r, doc_id, n, CASE WHEN a IS NULL THEN words
    ELSE list_transform(range(n), lambda i: words[(1 + CASE WHEN i >= a THEN a + (i - a) % p ELSE i END)::BIGINT]) END AS words FROM chosen),
fours AS (SELECT r, i, array_to_string(words[i + 1 : i + 4], ' ') AS four FROM (SELECT r, words, unnest(range(n - 3)) AS i FROM planted WHERE n >= 4)),
equal AS (SELECT x.r, x.i, y.i - x.i AS q FROM fours x JOIN fours y ON x.r = y.r AND x.four = y.four AND y.i > x.i),
islands AS (SELECT r, q, min(i) AS start, count(*) + 3 + q AS length
    FROM (SELECT r, q, i, i - row_number() OVER (PARTITION BY r, q ORDER BY i) AS island FROM equal) GROUP BY r, q, island),
runs AS (SELECT r, start, length, min(q) AS period FROM islands WHERE length >= greatest(12, 2 * q) GROUP BY r, start, length),
told AS (SELECT r, count(*) AS n_runs, arg_min(struct_pack(start := start, length := length, period := period), struct_pack(a := -length, b := start, c := period)) AS best,
    string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS lines FROM runs GROUP BY r),
dropped AS (SELECT DISTINCT r, unnest(range(start + period, start + length)) AS i FROM runs),
kept AS (SELECT w.r, string_agg(w.word, ' ' ORDER BY w.i) AS text
    FROM (SELECT r, unnest(range(n)) AS i, unnest(words) AS word FROM planted) w ANTI JOIN dropped d ON w.r = d.r AND w.i = d.i GROUP BY w.r)
SELECT p.doc_id, coalesce(t.n_runs, 0) AS n_runs, t.best.start AS start, t.best.length AS length, t.best.period AS period,
    1000 * t.best.length // t.best.period AS exponent_milli, sha256(coalesce(t.lines, '')) AS runs_sha256, sha256(coalesce(k.text, '')) AS collapsed_sha256
FROM planted p LEFT JOIN told t ON p.r = t.r LEFT JOIN kept k ON p.r = k.r
"""


def _written(value: str) -> str:
    return f"coalesce(strlen({value}::VARCHAR) || ':' || {value}, '-')"


_HEAD = " || ".join(_written(c) for c in ("doc_id", "source", "lang", "n_chars"))
MERKLE_MANIFEST = rf"""
WITH RECURSIVE crc AS (SELECT {_CRC_TABLE} AS entries),
hashed AS (SELECT doc_id, source, sha256({_HEAD} || {_written("text")}) AS leaf,
    CASE WHEN {_crc32("doc_id")} % 2 = 0 THEN replace(text, chr(10), '') ELSE text END AS changed, {_HEAD} AS head FROM documents, crc),
leaves AS (SELECT doc_id, leaf, sha256(head || {_written("changed")}) AS changed, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree,
    row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, count(*) OVER (PARTITION BY source) AS n FROM hashed),
nodes(tree, level, i, n, digest) AS (SELECT tree, 0, i, n, leaf FROM leaves
    UNION ALL SELECT tree, level + 1, i // 3, (n + 2) // 3, sha256(string_agg(digest, '' ORDER BY i)) FROM nodes WHERE n > 1 GROUP BY tree, level, i // 3, n),
subroots AS (SELECT tree, digest, count(*) OVER () AS n FROM nodes WHERE n = 1),
above(level, i, n, digest) AS (SELECT 0, tree, n, digest FROM subroots
    UNION ALL SELECT level + 1, i // 3, (n + 2) // 3, sha256(string_agg(digest, '' ORDER BY i)) FROM above WHERE n > 1 GROUP BY level, i // 3, n),
powers AS (SELECT k, (3 ** k)::BIGINT AS power FROM range(20) AS t(k)),
near AS (SELECT l.tree, l.i, 0 AS part, s.level, s.i AS place, s.digest, s.i < l.i // p.power AS left_, s.i = l.i // p.power AS own
    FROM leaves l JOIN nodes s ON l.tree = s.tree AND s.n > 1 JOIN powers p ON p.k = s.level AND s.i // 3 = l.i // p.power // 3
  UNION ALL SELECT t.tree, NULL, 1, s.level, s.i, s.digest, s.i < t.tree // p.power, s.i = t.tree // p.power
    FROM subroots t JOIN above s ON s.n > 1 JOIN powers p ON p.k = s.level AND s.i // 3 = t.tree // p.power // 3),
steps AS (SELECT tree, i, part, level, coalesce(string_agg(digest, '' ORDER BY place) FILTER (WHERE left_), '') AS before,
    coalesce(string_agg(digest, '' ORDER BY place) FILTER (WHERE NOT left_ AND NOT own), '') AS after FROM near GROUP BY tree, i, part, level),
low AS (SELECT tree, i, list(before || '|' || after ORDER BY level) AS steps FROM steps WHERE part = 0 GROUP BY tree, i),
high AS (SELECT tree, list(before || '|' || after ORDER BY level) AS steps FROM steps WHERE part = 1 GROUP BY tree),
proofs AS (SELECT l.*, s.digest AS subroot, (SELECT digest FROM above WHERE n = 1) AS root, list_concat(coalesce(low.steps, []), coalesce(high.steps, [])) AS steps
    FROM leaves l JOIN subroots s ON l.tree = s.tree LEFT JOIN low ON l.tree = low.tree AND l.i = low.i LEFT JOIN high ON l.tree = high.tree),
folded AS (SELECT *, list_reduce(list_concat([changed], steps), lambda acc, s: sha256(split_part(s, '|', 1) || acc || split_part(s, '|', 2))) AS folded_root FROM proofs)
SELECT doc_id, leaf, subroot, root, sha256(replace(array_to_string(steps, ''), '|', '')) AS proof_sha256, folded_root, folded_root = root AS verified FROM folded
"""

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = rf"regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
BENCHMARK_HITS = f"""
WITH items AS (SELECT item_id, {_WORDS} AS words FROM benchmark),
sized AS (SELECT item_id, words, least(10, len(words)) AS size FROM items WHERE len(words) > 0),
windows AS (SELECT DISTINCT item_id, size, array_to_string(words[i + 1 : i + size], ' ') AS w
    FROM (SELECT item_id, words, size, unnest(range(len(words) - size + 1)) AS i FROM sized)),
docs AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS words FROM documents),
grams AS (SELECT r, i, size, array_to_string(words[i + 1 : i + size], ' ') AS w
    FROM (SELECT r, words, size, unnest(range(len(words) - size + 1)) AS i FROM docs, (SELECT DISTINCT size FROM windows) WHERE len(words) >= size)),
met AS (SELECT g.r, g.i, g.size, w.item_id FROM grams g JOIN windows w ON g.size = w.size AND g.w = w.w),
hit AS (SELECT r, count(DISTINCT place) AS n_hit FROM (SELECT DISTINCT r, unnest(range(i, i + size)) AS place FROM met) GROUP BY r),
named AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT r, item_id::VARCHAR AS item FROM met WHERE item_id IS NOT NULL) GROUP BY r)
SELECT d.doc_id, len(d.words) AS n_words, coalesce(h.n_hit, 0) AS n_hit, coalesce(m.n_items, 0) AS n_items,
    sha256(coalesce(m.items, '')) AS items_sha256, h.n_hit IS NOT NULL AS contaminated
FROM docs d LEFT JOIN hit h ON d.r = h.r LEFT JOIN named m ON d.r = m.r
"""

#: The schedule's points repeat the operator's arithmetic.
MIXTURE = rf"""
WITH sized AS (SELECT row_number() OVER () AS r, doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^ \t\n\x0b\x0c\r]+')) AS size,
    md5(coalesce(doc_id::VARCHAR, '') || ' ' || coalesce(md5(text), '')) AS draw FROM documents),
sources AS (SELECT source, sum(size) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS no FROM sized GROUP BY source),
weighed AS (SELECT *, CASE (no - 1) % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS weight, source_size * 2.0::DOUBLE AS cap FROM sources),
leveled AS (SELECT *, (sum(source_size) OVER () * 1.5::DOUBLE - coalesce(sum(cap) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(weight) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM weighed),
targets AS (SELECT *, coalesce(least(cap, weight * (SELECT arg_min(level, cap / weight) FROM leveled WHERE cap / weight >= level)), cap) AS target FROM leveled),
quotas AS (SELECT *, floor(target)::BIGINT AS quota, sum(floor(target)::BIGINT) OVER (ORDER BY no) AS high, sum(floor(target)::BIGINT) OVER () AS total FROM targets),
slots AS (SELECT slot, turn - floor(turn) AS point FROM (SELECT slot, floor(slot / {RUN}::DOUBLE) * {GOLDEN_RUN!r}::DOUBLE + (slot % {RUN} + 1) * {GOLDEN!r}::DOUBLE AS turn
    FROM (SELECT unnest(range((SELECT (max(total)::BIGINT + {BLOCK} - 1) // {BLOCK} FROM quotas))) AS slot))),
ranked AS (SELECT no, quota, slot, row_number() OVER (PARTITION BY no ORDER BY slot) - 1 AS block FROM slots JOIN quotas
    ON quota > 0 AND point >= (high - quota)::DOUBLE / total::DOUBLE AND point < high::DOUBLE / total::DOUBLE),
reached AS (SELECT * FROM ranked WHERE block * {BLOCK} < quota),
closing AS (SELECT q.no, q.quota, (SELECT count(*) FROM slots) + q.no AS slot, unnest(range(coalesce(n, 0), (q.quota + {BLOCK} - 1) // {BLOCK})) AS block
    FROM quotas q LEFT JOIN (SELECT no, count(*) AS n FROM reached GROUP BY no) r ON q.no = r.no WHERE q.quota > 0),
schedule AS (SELECT no, slot, block, block * {BLOCK} AS begin_, least(block * {BLOCK} + {BLOCK}, quota) AS end_ FROM (FROM reached UNION ALL BY NAME FROM closing)),
placed AS (SELECT s.r, s.doc_id, s.size, t.no, t.source_size, t.target,
    coalesce(sum(size) OVER (PARTITION BY t.no ORDER BY draw, doc_id NULLS FIRST, r ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS begin_
    FROM sized s JOIN quotas t ON s.source IS NOT DISTINCT FROM t.source),
passes AS (SELECT r, no, begin_ + turn * source_size AS from_, begin_ + turn * source_size + size AS to_ FROM placed, range(2) AS t(turn) WHERE size > 0),
touched AS (SELECT *, unnest(range(from_::BIGINT // {BLOCK}, (to_::BIGINT - 1) // {BLOCK} + 1)) AS block FROM passes),
met AS (SELECT r, slot, least(to_, s.end_) - greatest(from_, s.begin_) AS words FROM touched p JOIN schedule s ON p.no = s.no AND p.block = s.block),
taken AS (SELECT r, sum(words)::BIGINT AS taken, min(slot) AS first_slot, max(slot) AS last_slot FROM met WHERE words > 0 GROUP BY r)
SELECT p.doc_id, p.size::BIGINT AS size, p.source_size::BIGINT AS source_size, p.target, coalesce(t.taken, 0) AS taken, t.first_slot, t.last_slot
FROM placed p LEFT JOIN taken t ON p.r = t.r
"""

ORACLES = {"op6_mixture": MIXTURE, "op11_periodic_runs": PERIODIC_RUNS, "op12_merkle_manifest": MERKLE_MANIFEST, "op13_benchmark_hits": BENCHMARK_HITS}
