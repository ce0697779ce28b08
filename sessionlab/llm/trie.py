"""Prefix trie of conversations by the Euler-tour technique.

A conversation is rebuilt from the first turns of its base and its own later
turns.  Every distinct prefix of rebuilt turns is a node.

1. Turns are numbered inside their conversations through one global index
   (no window holds a whole conversation); a prefix is named by its depth and
   four running sums of 32-bit hashes of (place, digest of the turn), which
   add up over buckets of turns, so a long conversation is never in one task.
2. Nodes are numbered by (smallest member, depth).  Children are ordered by
   their smallest members, which links every node to its first child and its
   next sibling and so gives the successor of its enter and its exit arc.
3. The tour is list-ranked.  Arcs of nodes numbered alike lie together: each
   bucket contracts its runs with numpy.  The runs left are halved by random
   mates, one aggregate a round, down to a bounded list that is ranked in one
   group; then the rounds are undone, one join each.
4. Sums of leaf and saving weights over arc positions are taken in buckets of
   positions; a node's subtree is the difference between its two arcs.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sessionlab.functions.ranking import global_row_index
from sessionlab.llm.common import col
from sessionlab.sources.store import stage

LANES = 4
TURN_BUCKET = 256        # turns of a conversation summed in one window
ARC_BUCKET = 8192        # arcs contracted or summed in one group
LAST_RUNS = 4096         # runs that one group ranks
CHUNK_IDS = 1000         # member ids in one piece of text

_KEY = ["depth", *[f"p{i}" for i in range(LANES)]]


def borrowed(conv_id: Column) -> Column:
    """Turns a conversation takes from its base: crc32 of its decimal id mod 9."""
    return (F.crc32(conv_id.cast("string").cast("binary")) % 9).cast("long")


def numbered_turns(conversations: DataFrame, id_col="conv_id", turn_col="turn", role_col="role",
                   text_col="text") -> DataFrame:
    """(c, digest, bytes, at): turns with a global index in order of
    conversation, turn (null first) and digest of role and text."""
    role = F.coalesce(col(conversations, role_col).cast("string"), F.lit(""))
    text = F.coalesce(col(conversations, text_col).cast("string"), F.lit(""))
    rows = conversations.select(
        col(conversations, id_col).cast("long").alias("c"), col(conversations, turn_col).cast("long").alias("turn"),
        F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256).alias("digest"),
        F.octet_length(text).cast("long").alias("bytes")).where("c is not null")
    return global_row_index(rows, ["c", F.col("turn").asc_nulls_first(), "digest"], "at").drop("turn")


def rebuilt(turns: DataFrame, group: int = 5, longest: int = 8) -> tuple[DataFrame, DataFrame]:
    """Turns (c, place from 1, digest, bytes) of the rebuilt conversations, and
    every conversation (c, length).  A turn among the first ``longest`` of a
    base goes to at most ``2 * group - 1`` conversations."""
    convs = turns.groupBy("c").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("own"))
    base = convs.select(F.col("c").alias("base"), F.col("own").alias("base_own"))
    head = F.least(F.col("h"), F.coalesce("base_own", F.lit(0).cast("long")))
    convs = (convs.withColumn("h", borrowed(F.col("c"))).withColumn("base", F.col("c") - F.col("c") % group)
             .join(base, "base", "left").withColumn("head", head)
             .select("c", "first", "h", "head", (F.col("head") + F.greatest(F.col("own") - F.col("h"), F.lit(0))).alias("length")))
    at = turns.join(convs, "c").withColumn("n", F.col("at") - F.col("first") + 1)
    own = at.where("n > h").select("c", (F.col("n") - F.col("h") + F.col("head")).alias("place"), "digest", "bytes")
    spread = F.explode(F.sequence(F.lit(1 - group), F.lit(group - 1)))
    lent = (at.where((F.col("n") <= longest) & (F.col("c") % group == 0))
            .select(F.col("c").alias("b"), F.col("n").alias("place"), "digest", "bytes", spread.alias("near"))
            .withColumn("c", F.col("b") + F.col("near"))
            .where((F.col("c") - F.col("c") % group == F.col("b")) & (F.col("place") <= borrowed(F.col("c"))))
            .join(convs.select("c"), "c").select("c", "place", "digest", "bytes"))
    return own.unionByName(lent), convs.select("c", "length")


def prefixes(turns: DataFrame) -> DataFrame:
    """Turns with ``depth``, the running sums p0..p3 that name the prefix, and
    q0..q3 that name the prefix one turn shorter."""
    hashed = []
    for i in range(LANES // 2):
        h = F.xxhash64(F.lit(i), F.col("place"), F.col("digest"))
        hashed += [h.bitwiseAND(F.lit(0xFFFFFFFF)).alias(f"h{2 * i}"), F.shiftrightunsigned(h, 32).alias(f"h{2 * i + 1}")]
    rows = turns.select("c", "place", "bytes", *hashed, F.floor(F.col("place") / TURN_BUCKET).alias("bucket"))
    lanes = range(LANES)
    inside = Window.partitionBy("c", "bucket").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    local = rows.select("c", "bucket", "place", "bytes", *[f"h{i}" for i in lanes],
                        *[F.sum(f"h{i}").over(inside).alias(f"s{i}") for i in lanes])
    before = Window.partitionBy("c").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    totals = rows.groupBy("c", "bucket").agg(*[F.sum(f"h{i}").alias(f"t{i}") for i in lanes])
    carried = totals.select("c", "bucket", *[F.coalesce(F.sum(f"t{i}").over(before), F.lit(0)).alias(f"b{i}") for i in lanes])
    both = local.join(carried, ["c", "bucket"])
    return both.select("c", F.col("place").alias("depth"), "bytes",
                       *[(F.col(f"s{i}") + F.col(f"b{i}")).alias(f"p{i}") for i in lanes],
                       *[(F.col(f"s{i}") + F.col(f"b{i}") - F.col(f"h{i}")).alias(f"q{i}") for i in lanes])


def contract(arcs: pa.Table) -> pa.Table:
    """Runs of one bucket: every arc with the head of its run and its offset
    there; a head also with the arc after its run and the run's length."""
    a, after, length = (arcs.column(n).to_numpy() for n in ("a", "after", "length"))
    order = np.argsort(a, kind="stable")
    a, after, length = a[order], after[order], length[order]
    at = np.minimum(np.searchsorted(a, after), len(a) - 1)
    inside = a[at] == after
    up = np.arange(len(a))
    offset = np.zeros(len(a), np.int64)
    up[at[inside]] = np.flatnonzero(inside)
    offset[at[inside]] = length[inside]
    while True:
        higher = up[up]
        if (higher == up).all():
            break
        offset, up = offset + offset[up], higher
    last = np.flatnonzero(~inside)
    next_arc, run = np.full(len(a), -2, np.int64), np.zeros(len(a), np.int64)
    next_arc[up[last]] = after[last]
    run[up[last]] = offset[last] + length[last]
    return pa.table({"a": a, "head": a[up], "offset": offset, "after": next_arc, "length": run})


_RUNS = "a long, head long, offset long, after long, length long"


def list_rank(arcs: DataFrame, bucket: int = ARC_BUCKET, last_runs: int = LAST_RUNS) -> DataFrame:
    """(a, position) of the arcs (a, after) of one list; the last arc's
    ``after`` is -1.  Arcs close in number should often follow each other."""
    def contracted(rows: DataFrame, group: Column) -> DataFrame:
        return stage(rows.withColumn("_g", group).groupBy("_g").applyInArrow(contract, _RUNS), "tour")

    near = contracted(arcs.withColumn("length", F.lit(1).cast("long")), F.floor(F.col("a") / bucket))
    runs = near.where("a = head").select("a", "after", "length")
    rounds = []
    while runs.count() > last_runs:
        coin = lambda c: F.xxhash64(F.lit(len(rounds)), c).bitwiseAND(F.lit(1)) == 1
        takes = ~coin(F.col("a")) & (F.col("after") >= 0) & coin(F.col("after"))
        this = F.struct("a", "after", "length")
        met = stage(runs.groupBy(F.when(takes, F.col("after")).otherwise(F.col("a")).alias("at"))
                    .agg(F.max(F.when(takes, this)).alias("v"), F.max(F.when(~takes, this)).alias("u")), "tour")
        head = F.coalesce("v.a", "u.a").alias("head")
        kept = F.struct(F.coalesce("v.a", "u.a").alias("a"), F.lit(0).cast("long").alias("offset"))
        gone = F.when(F.col("v").isNotNull(), F.struct(F.col("u.a").alias("a"), F.col("v.length").alias("offset")))
        rounds.append(met.select(head, F.explode(F.array_compact(F.array(kept, gone))).alias("x")).select("head", "x.*"))
        runs = met.select(F.coalesce("v.a", "u.a").alias("a"), "u.after",
                          (F.col("u.length") + F.coalesce("v.length", F.lit(0))).alias("length"))
    placed = contracted(runs, F.lit(0)).select("a", F.col("offset").alias("position"))

    def undo(members: DataFrame, heads: DataFrame) -> DataFrame:
        return (members.join(heads.select(F.col("a").alias("head"), "position"), "head")
                .select("a", (F.col("position") + F.col("offset")).alias("position")))

    for members in reversed(rounds):
        placed = stage(undo(members, placed), "tour")
    return undo(near.select("a", "head", "offset"), placed)


def _packed(batches):
    """Sorted (node, c) rows to pieces of comma-joined ids of one node."""
    for batch in batches:
        node = batch.column("node").to_numpy()
        c = batch.column("c").to_numpy()
        cuts = np.flatnonzero(np.diff(node)) + 1
        cuts = np.unique(np.concatenate([cuts, np.arange(0, len(node), CHUNK_IDS)]))
        ends = np.append(cuts[1:], len(node))
        text = [",".join(map(str, c[i:j].tolist())) for i, j in zip(cuts, ends)]
        yield pa.RecordBatch.from_arrays([pa.array(node[cuts]), pa.array(c[cuts]), pa.array(text, pa.string())],
                                         names=["node", "c", "ids"])


def _digests(batches):
    """Sorted (node, c, ids) pieces to one SHA-256 per node; the hash of a node
    is carried from batch to batch."""
    at, state = None, None
    for batch in batches:
        out = []
        for node, ids in zip(batch.column("node").to_pylist(), batch.column("ids").to_pylist()):
            if node != at:
                if state is not None:
                    out.append((at, state.hexdigest()))
                at, state = node, hashlib.sha256(ids.encode())
            else:
                state.update(b"," + ids.encode())
        if out:
            yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.int64()), pa.array([x[1] for x in out])],
                                             names=["node", "ends_sha256"])
    if state is not None:
        yield pa.RecordBatch.from_arrays([pa.array([at], pa.int64()), pa.array([state.hexdigest()])],
                                         names=["node", "ends_sha256"])


def ends_digest(ends: DataFrame) -> DataFrame:
    """(node, ends_sha256): SHA-256 of each node's ids in ascending order.
    Ids are sorted and packed by ranges of (node, id), so a popular node's ids
    are spread; the hash itself is a stream by nature and reads the pieces of
    its node, a row per ``CHUNK_IDS`` ids, without holding them."""
    pieces = (ends.repartitionByRange("node", "c").sortWithinPartitions("node", "c")
              .mapInArrow(_packed, "node long, c long, ids string"))
    return (pieces.repartition("node").sortWithinPartitions("node", "c")
            .mapInArrow(_digests, "node long, ends_sha256 string"))


def trie(conversations: DataFrame, id_col="conv_id", turn_col="turn", role_col="role", text_col="text",
         bucket: int = ARC_BUCKET, last_runs: int = LAST_RUNS) -> DataFrame:
    """One row per node: conv_id (smallest member), depth, parent_conv_id,
    n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    Rows without an id take no part.  Null role or text is empty; a null turn
    comes first; turns equal in number are ordered by the SHA-256 of role and
    text, so equal rows stay, one after another.  A conversation that ends up
    turnless is a member of the root only.  An empty table gives no rows.
    Other columns are not read.
    """
    turns, convs = rebuilt(numbered_turns(conversations, id_col, turn_col, role_col, text_col))
    convs = stage(convs, "trie_conversations")
    rows = stage(prefixes(turns), "trie_prefixes")

    lanes = range(LANES)
    zero = F.lit(0).cast("long")
    found = rows.groupBy(*_KEY).agg(F.min("c").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"),
                                    F.min("bytes").alias("bytes"), *[F.min(f"q{i}").alias(f"q{i}") for i in lanes])
    root = (convs.agg(F.min("c").alias("conv_id"), F.count(F.lit(1)).alias("n_convs")).where("n_convs > 0")
            .select(zero.alias("depth"), *[zero.alias(f"p{i}") for i in lanes], "conv_id", "n_convs", zero.alias("bytes"),
                    *[zero.alias(f"q{i}") for i in lanes]))
    nodes = global_row_index(found.unionByName(root), ["conv_id", "depth"], "node")

    # the root is number 0: it has the smallest id of all and no depth
    above = nodes.where("depth > 0").select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"),
                                            (F.col("depth") + 1).alias("depth"), *[F.col(f"p{i}").alias(f"q{i}") for i in lanes])
    deep = nodes.where("depth > 1").join(above, ["depth", *[f"q{i}" for i in lanes]])
    top = nodes.where("depth <= 1").join(F.broadcast(root.select(F.lit(1).cast("long").alias("depth"), F.col("conv_id").alias("root_id"))),
                                         "depth", "left")
    keep = ["node", "conv_id", "depth", "n_convs", "bytes", *[f"p{i}" for i in lanes]]
    linked = stage(deep.select(*keep, "parent", "parent_conv_id").unionByName(top.select(
        *keep, F.when(F.col("depth") > 0, zero).alias("parent"),
        F.col("root_id").alias("parent_conv_id"))), "trie_nodes")

    placed = global_row_index(linked.where("parent is not null").select("parent", "node"), ["parent", "node"], "r")
    mine = F.floor(F.col("r") / bucket)
    shared = F.when(F.col("r") % bucket == 0, F.array(mine, mine - 1)).otherwise(F.array(mine))
    by = Window.partitionBy("g").orderBy("r")
    siblings = (placed.withColumn("g", F.explode(shared))
                .select("node", "parent", "g", (F.col("g") == mine).alias("own"),
                        F.lead("node").over(by).alias("after"), F.lead("parent").over(by).alias("after_parent"))
                .where("own").select("node", F.when(F.col("after_parent") == F.col("parent"), F.col("after")).alias("sibling")))
    children = (linked.where("parent is not null").groupBy("parent")
                .agg(F.min("node").alias("first_child"), F.count(F.lit(1)).alias("n_children"))
                .withColumnRenamed("parent", "node"))
    links = stage(linked.join(children, "node", "left").join(siblings, "node", "left")
                  .withColumn("n_children", F.coalesce("n_children", zero)), "trie_links")

    enter, leave = F.col("node") * 2, F.col("node") * 2 + 1
    arcs = links.select(F.explode(F.array(
        F.struct(enter.alias("a"), F.coalesce(F.col("first_child") * 2, leave).alias("after")),
        F.struct(leave.alias("a"), F.coalesce(F.col("sibling") * 2, F.col("parent") * 2 + 1, F.lit(-1)).alias("after"))
    )).alias("x")).select("x.*")
    ranked = stage(list_rank(arcs, bucket, last_runs), "trie_tour")

    weights = links.select(enter.alias("a"), (F.col("n_children") == 0).cast("long").alias("leaf"),
                           ((F.col("n_convs") - 1) * F.col("bytes")).alias("saved"))
    weighed = (ranked.join(weights, "a", "left")
               .select("a", "position", F.coalesce("leaf", zero).alias("leaf"), F.coalesce("saved", zero).alias("saved"),
                       F.floor(F.col("position") / bucket).alias("g")))
    before = Window.orderBy("g").rowsBetween(Window.unboundedPreceding, -1)
    totals = (weighed.groupBy("g").agg(F.sum("leaf").alias("l"), F.sum("saved").alias("s"))    # a row per bucket
              .select("g", *[F.coalesce(F.sum(x).over(before), zero).alias(x) for x in ("l", "s")]))
    upto = Window.partitionBy("g").orderBy("position").rowsBetween(Window.unboundedPreceding, 0)
    sums = weighed.select("a", "g", "leaf", "saved", F.sum("leaf").over(upto).alias("cl"), F.sum("saved").over(upto).alias("cs")) \
        .join(totals, "g").select("a", "leaf", "saved", (F.col("cl") + F.col("l")).alias("cl"), (F.col("cs") + F.col("s")).alias("cs"))
    # an exit arc counts with the sums up to it, an enter arc with those before it
    leaving = F.col("a") % 2 == 1
    signed = lambda total, own: F.sum(F.when(leaving, F.col(total)).otherwise(F.col(own) - F.col(total)))
    subtree = sums.groupBy(F.floor(F.col("a") / 2).alias("node")).agg(signed("cl", "leaf").alias("n_leaves"),
                                                                    signed("cs", "saved").alias("saved_tokens"))

    ended = rows.join(convs.select("c", F.col("length").alias("depth")), ["c", "depth"])
    ends = ended.join(links.select("node", *_KEY), _KEY).select("node", "c").unionByName(
        convs.where("length = 0").select(zero.alias("node"), "c"))
    empty = hashlib.sha256(b"").hexdigest()
    return (links.join(subtree, "node").join(ends_digest(ends), "node", "left")
            .select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
                    F.coalesce("ends_sha256", F.lit(empty)).alias("ends_sha256")))
