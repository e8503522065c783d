"""The prefix tree of conversations, by ROLLUP over columns of turn ids.

A conversation is cut into blocks of ``BLOCK`` turns, a row each, with the block's turn ids in positional columns. One
``GROUP BY <node before the block>, ROLLUP (t1 .. tK)`` makes every prefix of every block at once: grouping_id tells how
long a prefix is. A node is known by its depth and an xor of hashes of its turns with their positions (128 bits), so the
node before any block is a running xor, and blocks of all depths go through the same aggregation, without a round per
block. A turn's id is the MD5 of role and text with the text's length behind it.

Sums over subtrees come from a second ROLLUP. Every node belongs to its smallest member, and a conversation owns its last
nodes, from some depth on; the sum over the subtree of a node is that of its owner's nodes from there on, plus everything
the other members own.

Nothing is gathered per conversation or node: turns are numbered within ranges of rows, sums along a conversation run
within pieces of ``PIECE`` turns, and the ids that end in a node are hashed as a stream of chunks, in order. SHA-256 goes
through its input in one order, so one task reads the chunks of one node; it holds one chunk at a time.

Odd rows: rows without ``conv_id`` belong to no conversation. Null roles and texts are empty; null turns come first, and
turns of equal number are in the order of the ids above, equal rows staying as separate turns. A table without
conversations has no nodes, not even a root.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .columns import stored

BLOCK = 8
PIECE = 8192  # turns of a conversation that one window sees; a multiple of BLOCK
CHUNK = 8192  # conversation ids in one chunk of a node's list
KEY = ["depth", "x", "y"]


def turn_id(role: Column, text: Column) -> Column:
    """24 bytes: MD5 of the role's length, role and text; then the text's length in bytes."""
    role, text = F.coalesce(role, F.lit("")), F.coalesce(text, F.lit(""))
    named = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    return F.unhex(F.concat(F.md5(named.cast("binary")), F.lpad(F.hex(F.octet_length(text).cast("long")), 16, "0")))


def numbered(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv, pos, t): turns numbered from 1 in order, however many of them one conversation has.

    Rows are dealt by ranges of (conversation, turn, id); a range's rows are numbered on their own, after the counts of the
    ranges before it.
    """
    rows = rows.where(F.col(conv).isNotNull()).select(
        F.col(conv).cast("long").alias("conv"), F.col(turn).alias("turn"), turn_id(F.col(role), F.col(text)).alias("t"),
        F.monotonically_increasing_id().alias("row"))
    order = [F.asc_nulls_first("turn"), F.asc("t"), F.asc("row")]
    dealt = stored(rows.repartitionByRange("conv", *order).withColumn("part", F.spark_partition_id()), "turns")
    counts = dealt.groupBy("conv", "part").count()
    before = F.sum("count").over(Window.partitionBy("conv").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    counts = counts.select("conv", "part", F.coalesce(before, F.lit(0)).alias("before"))
    nth = F.row_number().over(Window.partitionBy("conv", "part").orderBy(*order))
    return stored(dealt.join(counts, ["conv", "part"]).select("conv", (F.col("before") + nth).alias("pos"), "t"), "turns-numbered")


def rebuilt(turns: DataFrame, base: Column, heads: Column, most: int) -> tuple[DataFrame, DataFrame]:
    """Every conversation as the first ``heads`` turns of conversation ``base`` followed by its own after its first ``heads``.

    ``base`` and ``heads`` are expressions over ``conv``; ``heads`` is at most ``most``. Returns (conv, pos, t) and
    (conv, length); a conversation may end up without a turn.
    """
    totals = turns.groupBy("conv").agg(F.max("pos").alias("n")).withColumn("base", base).withColumn("h", heads.cast("long"))
    of_base = totals.select(F.col("conv").alias("base"), F.col("n").alias("n_base"))
    plan = totals.join(of_base, "base", "left").select(
        "conv", "base", "h", "n", F.least("h", F.coalesce("n_base", F.lit(0))).alias("taken"))
    lengths = plan.select("conv", (F.col("taken") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("length"))
    first = turns.where(F.col("pos") <= most).select(F.col("conv").alias("base"), "pos", "t")
    shared = plan.select("conv", "base", "taken").join(first, "base").where("pos <= taken").select("conv", "pos", "t")
    # a long conversation meets its one row of the plan in pieces
    own = turns.withColumn("_piece", F.floor(F.col("pos") / PIECE))
    per_piece = plan.select("conv", "h", "taken", F.explode(F.sequence(F.lit(0).cast("long"), F.floor(F.col("n") / PIECE))).alias("_piece"))
    own = own.join(per_piece, ["conv", "_piece"]).where("pos > h").select(
        "conv", (F.col("taken") + F.col("pos") - F.col("h")).alias("pos"), "t")
    return shared.unionByName(own), lengths


def _xors(t: Column, pos: Column) -> tuple[Column, Column]:
    none = F.lit(0).cast("long")
    return (F.when(t.isNull(), none).otherwise(F.xxhash64(t, pos)),
            F.when(t.isNull(), none).otherwise(F.xxhash64(F.lit(7), pos, t)))


def blocks(turns: DataFrame, lengths: DataFrame, width: int = BLOCK) -> DataFrame:
    """(conv, piece, block, t1 .. tK, x0, y0, x, y): a row per block of turns, with the node before it and the one after it."""
    # a row without a turn keeps conversations that have none
    turns = turns.unionByName(lengths.where("length = 0").select("conv", F.lit(0).cast("long").alias("pos"), F.lit(None).cast("binary").alias("t")))
    at = F.greatest(F.col("pos") - 1, F.lit(0))
    x, y = _xors(F.col("t"), F.col("pos"))
    rows = turns.select("conv", F.floor(at / PIECE).alias("piece"), F.floor(at / width).alias("block"), (at % width).alias("slot"), "t",
                        x.alias("x"), y.alias("y")).repartition("conv", "piece")
    made = rows.groupBy("conv", "piece", "block").agg(
        *[F.max(F.when(F.col("slot") == i, F.col("t"))).alias(f"t{i + 1}") for i in range(width)],
        F.bit_xor("x").alias("x"), F.bit_xor("y").alias("y"))
    earlier = Window.partitionBy("conv").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    carried = rows.groupBy("conv", "piece").agg(F.bit_xor("x").alias("x"), F.bit_xor("y").alias("y")).select(
        "conv", "piece", *[F.coalesce(F.bit_xor(c).over(earlier), F.lit(0)).alias(f"{c}_") for c in "xy"])
    upto = Window.partitionBy("conv", "piece").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    made = made.join(carried, ["conv", "piece"])
    for c in "xy":
        made = made.withColumn(f"{c}0", F.col(f"{c}_").bitwiseXOR(F.coalesce(F.bit_xor(c).over(upto), F.lit(0))))
    return made.select("conv", "piece", "block", *[f"t{i + 1}" for i in range(width)], "x0", "y0",
                       *[F.col(f"{c}0").bitwiseXOR(F.col(c)).alias(c) for c in "xy"])


def rolled_up(made: DataFrame, measures: dict[str, str], width: int = BLOCK) -> DataFrame:
    """``measures`` (SQL aggregates) for every node: (depth, x, y, px, py, t, measures), p for its parent, t its last turn."""
    turns = [f"t{i + 1}" for i in range(width)]
    sums = ", ".join(f"{sql} AS {name}" for name, sql in measures.items())
    rows = made.sparkSession.sql(
        f"SELECT block, x0, y0, {', '.join(turns)}, {width} - bit_count(grouping_id()) AS level, {sums} "
        f"FROM {{made}} GROUP BY block, x0, y0, ROLLUP ({', '.join(turns)})", made=made)
    # a prefix longer than its block's turns is none; the empty one is the node before the block, and a node for the root only
    last = F.coalesce(*[F.when(F.col("level") == i + 1, F.col(t)) for i, t in enumerate(turns)])
    rows = rows.withColumn("t", last).where(F.when(F.col("level") == 0, F.col("block") == 0).otherwise(F.col("t").isNotNull()))
    depth = F.col("block") * width + F.col("level")
    own = _xors(F.col("t"), depth)
    found = [_xors(F.col(t), F.col("block") * width + i + 1) for i, t in enumerate(turns)]
    for j, c in enumerate("xy"):
        whole = F.col(f"{c}0")
        for pair in found:
            whole = whole.bitwiseXOR(pair[j])
        rows = rows.withColumn(c, whole).withColumn(f"p{c}", whole.bitwiseXOR(own[j]))
    return rows.select(depth.alias("depth"), "x", "y", "px", "py", "t", *measures)


def _hashed_lists(ends: DataFrame) -> DataFrame:
    """SHA-256 of the ascending, comma-joined ``conv`` of every node, as (depth, x, y, n_ends, ends_sha256)."""
    def joined(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.stack([batch.column(k).to_numpy() for k in KEY])
            cuts = np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1
            cuts = np.unique(np.concatenate([[0], cuts, np.arange(0, batch.num_rows, CHUNK)]))
            text = batch.column("conv").cast(pa.string())
            lists = pa.ListArray.from_arrays(pa.array(np.append(cuts, batch.num_rows), pa.int32()), text)
            yield pa.RecordBatch.from_arrays(
                [*[pa.array(k[cuts]) for k in keys], batch.column("conv").take(pa.array(cuts)),
                 pa.array(np.diff(np.append(cuts, batch.num_rows))), pc.binary_join(lists, ",")],
                [*KEY, "first", "n", "ids"])

    def hashed(batches):
        at, state, count = None, None, 0

        def done():
            return pa.RecordBatch.from_pylist([dict(zip(KEY, at, strict=True), n_ends=count, ends_sha256=state.hexdigest())], schema=out)

        out = pa.schema([("depth", pa.int64()), ("x", pa.int64()), ("y", pa.int64()), ("n_ends", pa.int64()), ("ends_sha256", pa.string())])
        for batch in batches:
            made = []
            for *key, n, ids in zip(*(batch.column(c).to_pylist() for c in [*KEY, "n"]), batch.column("ids"), strict=True):
                if key != at:
                    if at is not None:
                        made.append((*at, count, state.hexdigest()))
                    at, state, count = key, hashlib.sha256(), 0
                state.update(b"," if count else b"")
                state.update(ids.as_buffer())
                count += n
            if made:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*made, strict=True), out, strict=True)], schema=out)
        if at is not None:
            yield done()

    chunks = ends.repartitionByRange(*KEY, "conv").sortWithinPartitions(*KEY, "conv").mapInArrow(
        joined, "depth bigint, x bigint, y bigint, first bigint, n bigint, ids string")
    return chunks.repartition(*KEY).sortWithinPartitions(*KEY, "first").mapInArrow(
        hashed, "depth bigint, x bigint, y bigint, n_ends bigint, ends_sha256 string")


def _owned(nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Sums of every node's and its owner's deeper nodes, and the depth at which the owner's nodes begin; all per owner."""
    rows = nodes.withColumn("piece", F.floor(F.col("depth") / PIECE))
    pieces = rows.groupBy("conv_id", "piece").agg(F.sum("saved").alias("saved"), F.sum("leaf").alias("leaves"), F.min("depth").alias("begin"))
    deeper = Window.partitionBy("conv_id").orderBy(F.desc("piece")).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("conv_id")
    pieces = pieces.select("conv_id", "piece", F.min("begin").over(whole).alias("begin"),
                           *[F.coalesce(F.sum(c).over(deeper), F.lit(0)).alias(f"{c}_") for c in ("saved", "leaves")],
                           *[F.sum(c).over(whole).alias(f"all_{c}") for c in ("saved", "leaves")])
    down = Window.partitionBy("conv_id", "piece").orderBy(F.desc("depth")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    made = rows.join(pieces, ["conv_id", "piece"])
    made = made.withColumn("own_saved", F.col("saved_") + F.sum("saved").over(down)).withColumn(
        "own_leaves", F.col("leaves_") + F.sum("leaf").over(down)).drop("saved_", "leaves_", "piece")
    totals = pieces.groupBy("conv_id").agg(F.first("all_saved").alias("all_saved"), F.first("all_leaves").alias("all_leaves"))
    return made, totals


def _parents(nodes: DataFrame, rows: int) -> DataFrame:
    """(depth, x, y, parent) of the nodes that are the first of their owner's; below those the parent is the owner's own.

    A parent of very many children would be one task's work, so the at most 1,024 parents that have more than a
    1,024th of all nodes as children are broadcast.
    """
    first = nodes.where("depth = begin and depth > 0").select(
        *KEY, F.struct((F.col("depth") - 1).alias("depth"), F.col("px").alias("x"), F.col("py").alias("y")).alias("p"))
    parents = nodes.where("n_children > 0").select(F.struct(*KEY).alias("p"), F.col("conv_id").alias("parent"), "n_children")
    wide = F.col("n_children") > max(rows // 1024, 1)
    by_wide = first.join(F.broadcast(parents.where(wide).drop("n_children")), "p", "left")
    by_other = by_wide.where("parent is null").drop("parent").join(parents.where(~wide).drop("n_children"), "p")
    return by_wide.where("parent is not null").unionByName(by_other).drop("p")


def tree(turns: DataFrame, lengths: DataFrame, width: int = BLOCK) -> DataFrame:
    """The nodes of conversations given as (conv, pos, t), pos from 1, and (conv, length).

    Columns: conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.
    """
    made = stored(blocks(turns, lengths, width), "blocks")
    size = F.coalesce(F.conv(F.hex(F.substring("t", 17, 8)), 16, 10).cast("long"), F.lit(0))
    nodes = rolled_up(made, {"n_convs": "count(*)", "conv_id": "min(conv)"}, width)
    nodes = nodes.select(*KEY, "px", "py", "conv_id", "n_convs", ((F.col("n_convs") - 1) * size).alias("saved"))
    nodes = stored(nodes, "nodes")
    children = nodes.where("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("px").alias("x"), F.col("py").alias("y")).agg(
        F.count("*").alias("n_children"))
    nodes = nodes.join(children, KEY, "left").fillna(0, ["n_children"]).withColumn("leaf", (F.col("n_children") == 0).cast("long"))
    owned, totals = _owned(nodes)
    owned = stored(owned, "owned")

    # what the members of a node own, by the second ROLLUP
    per_piece = totals.withColumnRenamed("conv_id", "conv").join(lengths, "conv").withColumn(
        "piece", F.explode(F.sequence(F.lit(0).cast("long"), F.floor(F.greatest(F.col("length") - 1, F.lit(0)) / PIECE)))).drop("length")
    weighed = made.join(per_piece, ["conv", "piece"], "left").fillna(0, ["all_saved", "all_leaves"])
    members = rolled_up(weighed, {"member_saved": "sum(all_saved)", "member_leaves": "sum(all_leaves)"}, width).drop("px", "py", "t")

    last = F.floor(F.greatest(F.col("length") - 1, F.lit(0)) / width)
    ends = made.select("conv", "piece", "block", "x", "y").join(
        lengths.select("conv", "length", F.floor(last * width / PIECE).alias("piece"), last.alias("block")), ["conv", "piece", "block"]).select(
        F.col("length").alias("depth"), "x", "y", "conv")
    parent = F.when(F.col("depth") == F.col("begin"), F.col("parent")).otherwise(F.col("conv_id"))
    # one row per node on every side
    return owned.join(members, KEY).join(_hashed_lists(ends), KEY, "left").join(_parents(owned, owned.count()), KEY, "left").select(
        "conv_id", "depth", parent.alias("parent_conv_id"), "n_convs", "n_children",
        (F.col("own_leaves") + F.col("member_leaves") - F.col("all_leaves")).alias("n_leaves"),
        (F.col("own_saved") + F.col("member_saved") - F.col("all_saved")).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256"))
