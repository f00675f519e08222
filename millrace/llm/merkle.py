"""Merkle manifest of a table, with an inclusion proof for every row by pointer jumping.

Each row is a leaf. The leaves of a group stand in the order of a key and are hashed three by three, level by
level, until one node remains, the group's subroot; the subroots, in the order of their groups, are hashed to the
root in the same way.

- Places: one range-partitioned sort of the leaves; a leaf's number in its group is its place less that of the
  group's first leaf, so no group is ever in one task.
- Trees: ``LEVELS`` levels at a time, from blocks of ``ARITY ** LEVELS`` neighbours.
- Proofs: every node holds the siblings on the way to an ancestor, at first its parent. Joining the nodes with
  themselves on that ancestor doubles the distance and appends the ancestor's siblings. After r rounds only
  nodes whose level is a multiple of 2**r are still asked for, and those of the tree of subroots; the leaves
  join the tables of all rounds one after the other, until all have reached the root.

Nodes are named (tree, level, number): tree is the place of the group's first leaf, or ``TOP`` for the tree of subroots.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.ordered import attach_row, global_order
from millrace.session import discard, materialise

#: Nodes that are hashed together.
ARITY = 3
#: Levels built by one pass.
LEVELS = 4
TOP, DONE = -1, -2
_NODE = ["tree", "level", "number"]
_ANCESTOR = ["to_tree", "to_level", "to_number"]
_STEPS = "array<struct<before:binary,after:binary>>"


def written(field: Column, text: bool = True) -> Column:
    """A field of a leaf: its UTF-8 length, a colon and its value; ``-`` if null."""
    value = field if text else field.cast("string")
    return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))


def leaf_of(*fields: Column) -> Column:
    """Digest of a row from its written fields."""
    return F.sha2(F.concat(*fields), 256)


def folded(leaf: Column, steps: Column) -> Column:
    """The root that a leaf and the siblings of its proof give."""
    return F.aggregate(
        steps, leaf, lambda digest, step: F.sha2(F.concat(F.lower(F.hex(step["before"])), digest, F.lower(F.hex(step["after"]))), 256)
    )


def siblings(steps: Column) -> Column:
    """The digests of a proof as hex text, from the leaf's level to the root's, left to right."""
    return F.array_join(F.transform(steps, lambda s: F.lower(F.concat(F.hex(s["before"]), F.hex(s["after"])))), "")


def _divided(number: Column, by: int) -> Column:
    """Whole quotient of a number from 0 to 2**53."""
    return ((number - number % by) / by).cast("bigint")


def _height(count: Column) -> Column:
    """Levels above ``count`` leaves until one node remains."""
    powers = F.array(*[F.lit(ARITY**k).cast("bigint") for k in range(39)])
    return F.size(F.filter(powers, lambda p: p < count))


def _merged(digests: Column) -> Column:
    """The level above some neighbours."""
    runs = F.sequence(F.lit(0), F.ceil(F.size(digests) / ARITY).cast("int") - 1)
    return F.transform(runs, lambda k: F.sha2(F.array_join(F.slice(digests, k * ARITY + 1, ARITY), ""), 256))


def _steps(digests: Column) -> Column:
    """For each of some neighbours, what stands before and after it among those hashed together with it."""

    def step(_: Column, i: Column) -> Column:
        first = i - i % ARITY
        before, after = F.slice(digests, first + 1, i % ARITY), F.slice(digests, i + 2, F.lit(ARITY - 1) - i % ARITY)
        return F.struct(F.unhex(F.array_join(before, "")).alias("before"), F.unhex(F.array_join(after, "")).alias("after"))

    return F.transform(digests, step)


def _blocks(nodes: DataFrame, trees: DataFrame, base: int) -> DataFrame:
    """``LEVELS`` levels from the nodes of level ``base``: per block of neighbours the rows, and the digests of each level.

    ``up`` is the number of levels that the block's tree still has.
    """
    block = _divided(F.col("number"), ARITY**LEVELS).alias("block")
    columns = ["number", "digest", *[c for c in nodes.columns if c not in ("tree", "number", "digest")]]
    blocks = nodes.groupBy("tree", block).agg(F.sort_array(F.collect_list(F.struct(*columns))).alias("rows")).join(trees, "tree")
    blocks = blocks.withColumn("up", F.least(F.lit(LEVELS), F.col("height") - base)).withColumn("d0", F.col("rows.digest"))
    for j in range(LEVELS):
        above = F.when(F.col("up") > j, _merged(F.col(f"d{j}"))).otherwise(F.array().cast("array<string>"))
        blocks = blocks.withColumn(f"d{j + 1}", above)
    return materialise(blocks, "merkle-blocks")


def _level(blocks: DataFrame, base: int, j: int, payload: Sequence[str] = ()) -> DataFrame:
    """The nodes of level ``base + j`` with their parent as ancestor; leaves also when they are roots themselves."""
    level = base + j
    own = blocks if level == 0 else blocks.filter(F.col("up") > j)
    parts = [_steps(F.col(f"d{j}")).alias("step"), *([F.col("rows").alias("row")] if level == 0 else [])]
    each = own.select("tree", "block", "height", "home", "up", F.posexplode(F.arrays_zip(*parts)).alias("i", "node"))
    number = F.col("block") * ARITY ** (LEVELS - j) + F.col("i")
    top = F.col("height") <= level + 1
    ancestor = [
        F.when(~top, F.col("tree")).when(F.col("home").isNotNull(), F.lit(TOP)).otherwise(F.lit(DONE)).cast("bigint").alias("to_tree"),
        F.when(~top, F.lit(level + 1)).otherwise(F.lit(0)).alias("to_level"),
        F.when(~top, _divided(number, ARITY)).otherwise(F.coalesce("home", number)).alias("to_number"),
    ]
    steps = F.when(F.col("up") > j, F.array("node.step")).otherwise(F.array()).cast(_STEPS).alias("steps")
    return each.select("tree", F.lit(level).alias("level"), number.alias("number"), *ancestor, steps, *[F.col(f"node.row.{c}").alias(c) for c in payload])


def _forest(nodes: DataFrame, trees: DataFrame, highest: int, payload: Sequence[str] = ()) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Build trees from their leaves: the leaves, the inner nodes below the roots, and the root of each tree.

    ``nodes`` has tree, number, digest and payload; ``trees`` has tree, height and home, the number of the tree's
    root among the subroots (null for the tree of subroots itself).
    """
    inner, roots, base = [], [], 0
    while True:
        blocks = _blocks(nodes, trees, base)
        if base == 0:
            leaves = _level(blocks, 0, 0, payload)
        inner += [_level(blocks, base, j) for j in range(LEVELS) if 0 < base + j <= highest]
        ended = F.col("height") <= base + LEVELS
        root = F.element_at(F.array(*[F.col(f"d{j}") for j in range(LEVELS + 1)]), F.col("up") + 1)[0]
        roots.append(blocks.filter(ended).select("tree", root.alias("digest")))
        nodes = blocks.filter(~ended).select("tree", F.col("block").alias("number"), F.col(f"d{LEVELS}")[0].alias("digest"))
        base += LEVELS
        if base >= highest:
            break
    empty = leaves.select(*_NODE, *_ANCESTOR, "steps").limit(0)
    return leaves, _stacked([empty, *inner]), _stacked(roots)


def _stacked(parts: Sequence[DataFrame]) -> DataFrame:
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def _jumped(nodes: DataFrame, ancestors: DataFrame) -> DataFrame:
    """``nodes`` moved on to the ancestors of their ancestors; those that have reached the root stay.

    What has reached the root gets a name of its own as ancestor, which meets nothing: one common name
    would send all such rows of a later join to one task.
    """
    far = ancestors.select(*[F.col(c).alias(f"at_{c}") for c in _NODE], *[F.col(c).alias(f"far_{c}") for c in (*_ANCESTOR, "steps")])
    met = nodes.join(far, [F.col(f"to_{c}") == F.col(f"at_{c}") for c in _NODE], "left")
    moved, ended = F.col("at_tree").isNotNull(), F.col("far_to_tree") == DONE
    ancestor = [
        F.when(moved, F.col("far_to_tree")).otherwise(F.col("to_tree")).alias("to_tree"),
        F.when(ended, F.pmod(F.hash("tree"), F.lit(1 << 30))).when(moved, F.col("far_to_level")).otherwise(F.col("to_level")).alias("to_level"),
        F.when(ended, F.col("number")).when(moved, F.col("far_to_number")).otherwise(F.col("to_number")).alias("to_number"),
    ]
    steps = F.when(moved, F.concat("steps", "far_steps")).otherwise(F.col("steps")).alias("steps")
    rest = [c for c in nodes.columns if c not in (*_NODE, *_ANCESTOR, "steps")]
    return met.select(*_NODE, *ancestor, steps, *rest)


def _proofs(leaves: DataFrame, inner: DataFrame, deepest: int) -> DataFrame:
    """Leaves with all steps to the root, which is at most ``deepest`` levels above them."""
    jumps, distance = materialise(inner, "merkle-jumps"), 1
    while True:
        leaves = _jumped(leaves, jumps)
        if 2 * distance - 1 >= deepest:
            return leaves
        wanted = jumps.filter((F.col("level") % (2 * distance) == 0) | (F.col("tree") == TOP))
        jumps, distance = materialise(_jumped(wanted, jumps), "merkle-jumps"), 2 * distance


def manifest(rows: DataFrame, leaf: Column, group: str, key: str, carry: Sequence[Column] = ()) -> DataFrame:
    """A row per row of the table: ``key``, ``group``, ``carry``, leaf, subroot, root, and its proof ``steps``.

    ``leaf`` is the digest of a row (:func:`leaf_of`), ``carry`` are further columns of the result with names of
    their own. Groups ascend by UTF-8 bytes, null first, and rows by ``key``, null first, then leaf. Repeated rows are
    leaves of their own. ``steps`` are the siblings from the leaf to the root, (before, after) as bytes; a table of
    one row has none, and its leaf is the root. An empty table gives no rows. Other columns of the table play no part
    unless ``leaf`` reads them.
    """
    names = [c for c in rows.select(*carry).columns] if carry else []
    picked = rows.select(F.col(group).alias("_group"), F.col(key).alias("_key"), leaf.alias("digest"), F.struct(*carry).alias("_carry") if carry else F.lit(0).alias("_carry"))
    held = materialise(picked, "merkle-leaves")
    placed = global_order(held, [F.col("_group").asc_nulls_first(), F.col("_key").asc_nulls_first(), F.col("digest")], "_place")
    discard(held)  # the order is written
    groups = placed.groupBy("_group").agg(F.min("_place").alias("tree"), F.count(F.lit(1)).alias("_count"))
    homes = global_order(groups, [F.col("tree")], "_home")
    trees = materialise(homes.select("_group", "tree", _height(F.col("_count")).alias("height"), (F.col("_home") - 1).alias("home")), "merkle-trees")
    seen = trees.agg(F.max("height"), F.count(F.lit(1))).first()
    highest, count = seen[0] or 0, seen[1]
    own = placed.join(trees.select("_group", "tree"), placed["_group"].eqNullSafe(trees["_group"])).drop(trees["_group"])
    nodes = own.select("tree", (F.col("_place") - F.col("tree")).alias("number"), "digest", "_key", "_carry")
    leaves, inner, subroots = _forest(nodes, trees.select("tree", "height", "home"), highest, ("digest", "_key", "_carry"))
    subroots = materialise(subroots.join(trees.select("_group", "tree", "home"), "tree"), "merkle-subroots")
    top = materialise(subroots.select(F.lit(TOP).cast("bigint").alias("tree"), F.col("home").alias("number"), "digest"), "merkle-top")
    top_height = next(h for h in range(64) if ARITY**h >= count)
    above = rows.sparkSession.createDataFrame([(TOP, top_height, None)], "tree bigint, height int, home bigint")
    top_leaves, top_inner, root = _forest(top, above, top_height)
    top_nodes = _stacked([top_leaves, top_inner])
    proofs = _proofs(leaves, _stacked([inner, top_nodes]), highest + top_height)
    named = proofs.join(subroots.select("tree", "_group", F.col("digest").alias("subroot")), "tree")
    whole = attach_row(named, root.select(F.col("digest").alias("root")))
    return whole.select(
        F.col("_key").alias(key), F.col("_group").alias(group), *[F.col(f"_carry.{c}").alias(c) for c in names], F.col("digest").alias("leaf"), "subroot", "root", "steps"
    )
