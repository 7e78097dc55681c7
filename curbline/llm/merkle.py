"""Merkle manifest of a table: one digest for all rows, and for each row the digests that prove it.

Rows are ordered and dealt into aligned blocks of a power of the fanout, each of which hashes its
own subtree. Then blocks exchange subtree roots in a butterfly: in every round the blocks at the
same place of up to ``FANOUT`` neighbouring subtrees swap roots, and each of them hashes the common
ancestor itself. After the last round every block knows the root and all siblings on the way to it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from curbline.llm.common import schema_with
from curbline.session import broadcast_if_small, stage

FANOUT = 3
# A block holds FANOUT ** HEIGHT leaves.
HEIGHT = 7
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
# Rounds between two staged tables.
ROUNDS_AHEAD = 6

_PATH = "array<struct<at: int, others: array<string>>>"


def leaf(columns: Sequence[Column]) -> Column:
    """SHA-256 over the columns: ``-`` for null, else the number of UTF-8 bytes, a colon and the value."""
    parts = []
    for column in columns:
        value = column.cast("string")
        parts.append(F.when(value.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value)))
    return F.sha2(F.concat(*parts), 256)


def digest(parts: Sequence[str]) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def levels(leaves: list[str], rounds: int | None) -> list[list[str]]:
    """The nodes of every level from the leaves up, for so many rounds, or until one node remains."""
    found = [leaves]
    while len(found[-1]) > 1 if rounds is None else len(found) <= rounds:
        below = found[-1]
        found.append([digest(below[k:k + FANOUT]) for k in range(0, len(below), FANOUT)])
    return found


def _rounds(blocks: int, height: int) -> int | None:
    """A group of one block ends with its root; the blocks of a larger group are all of one height."""
    return None if blocks == 1 else height


def _block_roots(height: int):
    def run(key: tuple, rows: pa.Table) -> pa.Table:
        blocks = rows.column("blocks")[0].as_py()
        leaves = rows.sort_by("place").column("leaf").to_pylist()
        root = levels(leaves, _rounds(blocks, height))[-1][0]
        return pa.table({"tree": [key[0].as_py()], "block": [key[1].as_py()], "blocks": [blocks], "root": [root]},
                        schema=pa.schema([("tree", pa.int64()), ("block", pa.int64()), ("blocks", pa.int64()), ("root", pa.string())]))
    return run


def _proofs(height: int, kept: Sequence[str]):
    def run(key: tuple, rows: pa.Table, states: pa.Table) -> pa.Table:
        rows = rows.sort_by("place")
        state = states.to_pylist()[0]
        nodes = levels(rows.column("leaf").to_pylist(), _rounds(state["blocks"], height))
        above = [(step["at"], step["others"]) for step in state["path"]]
        upper = "".join(other for _, others in above for other in others)
        proofs, folded = [], []
        for place, (own, altered) in enumerate(zip(nodes[0], rows.column("altered").to_pylist())):
            node, siblings = altered or own, []
            for level in nodes[:-1]:
                start = place - place % FANOUT
                left, right = level[start:place], level[place + 1:start + FANOUT]
                siblings += left + right
                node = digest([*left, node, *right])
                place //= FANOUT
            for at, others in above:
                node = digest([*others[:at], node, *others[at:]])
            proofs.append(hashlib.sha256(("".join(siblings) + upper).encode()).hexdigest())
            folded.append(node)
        count = len(folded)
        return pa.table([*(rows.column(c) for c in kept), rows.column("leaf"), pa.array([state["subroot"]] * count, pa.string()),
                         pa.array([state["root"]] * count, pa.string()), pa.array(proofs, pa.string()), pa.array(folded, pa.string())],
                        [*kept, "leaf", "subroot", "root", "proof_sha256", "folded_root"])
    return run


def placed(rows: DataFrame, group: str, order: Sequence[str]) -> DataFrame:
    """Adds ``tree``, the group's place among all groups, ``place``, the row's in its group, and ``rows``, the group's size.

    Groups go by their bytes, null first; rows by ``order``. The table is dealt by ranges of both, so
    a group may lie on many tasks; only row counts a range and group are brought together.
    """
    spark = rows.sparkSession
    count = int(spark.conf.get("spark.sql.shuffle.partitions"))
    keyed = rows.withColumn("named", F.col(group).isNotNull()).withColumn("name", F.coalesce(F.col(group).cast("string"), F.lit("")))
    keys = ["named", "name", *order]
    dealt = stage(keyed.repartitionByRange(count, *keys).sortWithinPartitions(*keys)
                  .withColumn("part", F.spark_partition_id())
                  .withColumn("seat", F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)), "merkle-dealt")
    earlier = Window.partitionBy("named", "name").orderBy("part")
    runs = stage(dealt.groupBy("named", "name", "part").agg(F.min("seat").alias("first"), F.count("*").alias("held"))
                 .withColumn("before", F.sum("held").over(earlier) - F.col("held")), "merkle-runs")
    opened = runs.filter("before = 0")
    # One number a range: how many groups begin in the ranges before it.
    starts = (opened.groupBy("part").agg(F.count("*").alias("groups"))
              .withColumn("earlier", F.sum("groups").over(Window.orderBy("part")) - F.col("groups")).select("part", "earlier"))
    inside = Window.partitionBy("part").orderBy("named", "name")
    trees = (opened.withColumn("seat", F.row_number().over(inside)).join(starts, "part")
             .select("named", "name", (F.col("earlier") + F.col("seat") - 1).alias("tree")))
    sizes = runs.groupBy("named", "name").agg(F.sum("held").alias("rows"))
    known = stage(runs.join(trees, ["named", "name"]).join(sizes, ["named", "name"]), "merkle-groups")
    joined = dealt.join(broadcast_if_small(known, 200), ["named", "name", "part"])
    return joined.withColumn("place", F.col("seat") - F.col("first") + F.col("before")).drop("part", "seat", "first", "held", "before", "named", "name")


def swap(state: DataFrame, tree: Column, node: Column, active: Column, lane: Column, held: Column, lanes: Column) -> DataFrame:
    """One round: runs of ``FANOUT`` nodes of a ``tree`` exchange roots, and every block hashes their parent.

    A node is known to ``held`` blocks, of which this one is number ``lane``. Block ``lane`` meets the
    blocks of that number of the other nodes in the run; a node with fewer blocks than the widest one of its run,
    ``lanes``, has them stand in for the missing ones. Inactive rows pass as they are.
    """
    away = F.when(active, F.sequence(lane, F.greatest(lanes - 1, lane), held)).otherwise(F.array(lane))
    me = F.struct(*[F.col(c) for c in state.columns if c not in ("root", "held")]).alias("me")
    sent = state.select(
        tree.alias("_tree"), F.when(active, F.floor(node / FANOUT)).otherwise(F.lit(-1)).cast("long").alias("_run"),
        F.when(active, F.pmod(node, F.lit(FANOUT))).otherwise(F.lit(0)).cast("int").alias("child"),
        active.alias("_active"), lane.alias("_lane"), "root", held.alias("held"), me, F.explode(away).alias("lane"))
    met = sent.groupBy("_tree", "_run", "lane").agg(
        F.first("_active").alias("active"),
        F.sort_array(F.collect_list(F.struct("child", "root", "held", F.when(F.col("lane") == F.col("_lane"), F.col("me")).alias("me")))).alias("run"))
    own = met.select("active", "run", F.explode(F.filter("run", lambda x: x["me"].isNotNull())).alias("own"))
    child = F.col("own.child")
    others = F.transform(F.filter("run", lambda x: x["child"] != child), lambda x: x["root"])
    step = F.struct(child.alias("at"), others.alias("others"))
    ancestor = F.sha2(F.concat_ws("", F.transform("run", lambda x: x["root"])), 256)
    add = lambda runs: F.aggregate(runs, F.lit(0).cast("long"), lambda total, x: total + x["held"])
    fixed = {"root": F.when(F.col("active"), ancestor).otherwise(F.col("own.root")),
             "path": F.when(F.col("active"), F.concat(F.col("own.me.path"), F.array(step))).otherwise(F.col("own.me.path")),
             "lane": F.col("own.me.lane") + F.when(F.col("active"), add(F.filter("run", lambda x: x["child"] < child))).otherwise(0),
             "held": F.when(F.col("active"), add(F.col("run"))).otherwise(F.col("own.held"))}
    return own.select(*((fixed[c] if c in fixed else F.col("own.me")[c]).alias(c) for c in state.columns))


def exchanged(roots: DataFrame) -> DataFrame:
    """``tree, block, blocks, root, path, subroot`` of every block after all rounds, within the trees and then over them."""
    most, trees = roots.agg(F.max("blocks"), F.max("tree")).first()
    state = roots.withColumn("path", F.array().cast(_PATH))
    state = state.select(*(F.col(c) for c in ("tree", "block", "blocks", "root", "path")), F.lit(0).cast("long").alias("lane"),
                         F.lit(1).cast("long").alias("held"))
    size, number = 1, 0
    while size < (most or 1):
        # Node k of this level is known to the blocks from k * size on; only the last node may have fewer.
        node = F.floor(F.col("block") / size)
        width = F.least(F.lit(size), F.col("blocks") - node * size).cast("long")
        alone = (F.floor(node / FANOUT) * FANOUT + 1) * size >= F.col("blocks")
        active = F.col("blocks") > size
        lane = F.when(active, F.pmod("block", F.lit(size))).otherwise(F.col("block"))
        state = swap(state, F.col("tree"), node, active, lane, width, F.when(alone, width).otherwise(F.lit(size).cast("long")))
        size, number = size * FANOUT, number + 1
        if number % ROUNDS_AHEAD == 0:
            state = stage(state, "merkle-rounds")
    state = stage(state.withColumn("subroot", F.col("root")).withColumn("lane", F.col("block")).withColumn("held", F.col("blocks")), "merkle-trees")
    widths = state.filter("block = 0").select(F.col("tree").alias("node"), "blocks")
    size = 1
    while size <= (trees or 0):
        run = F.floor(F.col("node") / (size * FANOUT))
        widest = (widths.groupBy(F.floor(F.col("node") / size).alias("node"), run.alias("run")).agg(F.sum("blocks").alias("held"))
                  .groupBy("run").agg(F.max("held").alias("lanes")))
        joined = state.join(broadcast_if_small(widest, 32), F.floor(F.col("tree") / (size * FANOUT)) == F.col("run")).drop("run")
        state = swap(joined, F.lit(0), F.floor(F.col("tree") / size), F.lit(True), F.col("lane"), F.col("held"), F.col("lanes")).drop("lanes")
        state = stage(state, "merkle-rounds")
        size *= FANOUT
    return state.drop("lane", "held")


def manifest(docs: DataFrame, group: str = "source", order: str = "doc_id", fields: Sequence[str] = FIELDS,
             altered: dict[str, Column] | None = None, where: Column | None = None, height: int = HEIGHT) -> DataFrame:
    """``order, leaf, subroot, root, proof_sha256, folded_root, verified`` for every row of ``docs``.

    A leaf is ``leaf`` of the ``fields``. The leaves of a group ascend by ``order``, nulls first, equal ones by digest;
    every ``FANOUT`` consecutive nodes become the SHA-256 of their digests, the last run also with fewer,
    until one is left. The groups' subroots, null first and then by bytes, give the root in the same way.
    ``proof_sha256`` covers the siblings of a row's nodes from its leaf to the root, left to right. ``folded_root``
    is worked out from those siblings and the row as it is read again: rows for which ``where`` is true
    have the columns in ``altered`` replaced first. Null texts and ids are hashed as null, repeated rows are leaves each,
    an empty table gives no rows; columns besides the named ones are not read.
    """
    changed = altered or {}
    again = leaf([changed.get(c, F.col(f"`{c}`")) for c in fields])
    rows = docs.select(F.col(f"`{order}`").alias("key"), F.col(f"`{group}`").alias("group"), leaf([F.col(f"`{c}`") for c in fields]).alias("leaf"),
                       (F.when(where, again) if where is not None else F.lit(None).cast("string")).alias("altered"))
    # Hashed once; texts are not read again. Equal leaves may change places, so their order of reading tells them apart.
    hashed = stage(rows.withColumn("tie", F.monotonically_increasing_id()), "merkle-leaves")
    leaves = placed(hashed, "group", ["key", "leaf", "tie"])
    width = FANOUT ** height
    leaves = stage(leaves.select("key", "leaf", "altered", "tree", "place", F.floor(F.col("place") / width).alias("block"),
                                 F.ceil(F.col("rows") / width).alias("blocks")), "merkle-placed")
    roots = stage(leaves.select("tree", "block", "blocks", "place", "leaf").groupBy("tree", "block")
                  .applyInArrow(_block_roots(height), "tree long, block long, blocks long, root string"), "merkle-roots")
    states = exchanged(roots)
    schema = schema_with(leaves, ["key"], "leaf string, subroot string, root string, proof_sha256 string, folded_root string")
    proved = (leaves.select("tree", "block", "place", "key", "leaf", "altered").groupBy("tree", "block")
              .cogroup(states.groupBy("tree", "block")).applyInArrow(_proofs(height, ["key"]), schema))
    return proved.select(F.col("key").alias(order), "leaf", "subroot", "root", "proof_sha256", "folded_root",
                         (F.col("folded_root") == F.col("root")).alias("verified"))
