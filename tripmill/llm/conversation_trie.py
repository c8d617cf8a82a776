"""Prefix trie of conversations, with sums over subtrees by centroid decomposition.

1. *Turns.* A range sort places the turns of a conversation, however many it has; a run of one
   conversation within a partition knows its place from the runs before it.
2. *Prefixes.* A turn at a depth is 128 hashed bits, and a prefix the sums of its turns' bits, so
   the prefixes of one long conversation are running sums over blocks, joined by the blocks' sums.
   Conversations with the same prefix are members of one node.
3. *Rollup.* The edges from nodes to their parents form a forest. A component's centroid is the
   deepest node that holds half of its weight. What lies in the component at or below the centroid is
   added up and given to the centroid and to each node on the path from it to the component's top; then
   the centroid goes and its component falls apart. An ancestor and a descendant are told apart by one
   centroid only, so each pair is counted once, and a chain of n nodes takes log n rounds.
   Components of more than ``LOCAL_NODES`` nodes are split by Spark, where the members' rest is the
   weight; the others are split inside tasks, many at a time.
4. *Ends.* The conversations that end in a node are joined to pieces of text in order, and the pieces
   hashed one by one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripmill.llm.common import sized_broadcast, skewed_join, stored

#: Conversations c - c % FAMILY to c share the first turns; how many is a checksum of c modulo HEADS.
FAMILY = 20
HEADS = 4
#: Components of at most so many nodes are rolled up within a task.
LOCAL_NODES = 1 << 13
#: Turns of one conversation that are summed up in one group.
BLOCK = 4096
#: Bytes of ids that are joined to one piece.
PIECE_BYTES = 1 << 20
_SUMS = ["s0", "s1", "s2", "s3"]


def turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, r, t, n_words): each turn with its place from 0 on and a hash of role and text.

    Turns are ordered by turn (null first), then role and text, where null is empty; rows without
    a conv_id belong to no conversation.
    """
    text = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("role", "text")]
    rows = conversations.where(F.col("conv_id").isNotNull()).select(F.col("conv_id").cast("long").alias("conv_id"), "turn", *text)
    order = ["conv_id", F.col("turn").asc_nulls_first(), "role"]
    # a prefix of the text is enough to deal out, and keeps the sampled keys short
    ranged = rows.repartitionByRange(*order, F.substring("text", 1, 32)).sortWithinPartitions(*order, "text")
    placed = stored(
        ranged.select(
            "conv_id",
            F.spark_partition_id().alias("run"),
            F.monotonically_increasing_id().alias("at"),
            F.unhex(F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"))).alias("t"),
            F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("n_words"),
        ),
        "trie-turns",
    )
    runs = placed.groupBy("conv_id", "run").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n"))
    # as many rows a conversation as partitions that hold it
    before = Window.partitionBy("conv_id").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select("conv_id", "run", (F.col("first") - F.coalesce(F.sum("n").over(before), F.lit(0))).alias("first"))
    return placed.join(runs, ["conv_id", "run"]).select("conv_id", (F.col("at") - F.col("first")).alias("r"), "t", "n_words")


def rebuilt(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rebuilt turns (conv_id, d, t, n_words, rest) with depths from 1 on, and (conv_id, length).

    Conversation c begins with the first h turns of conversation c - c % FAMILY, as far as there are
    any, and goes on with its own turns behind its first h; h is the unsigned crc32 of c as decimal
    text, modulo HEADS. ``rest`` counts the turns from this one to the end.
    """
    own = stored(turns(conversations), "trie-own")
    sizes = own.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n"))
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % HEADS
    sizes = stored(sizes.select("conv_id", "n", h.alias("h"), (F.col("conv_id") - F.col("conv_id") % FAMILY).alias("base")), "trie-sizes")
    taken = F.least("h", F.coalesce("n_base", F.lit(0)))
    plans = stored(
        sizes.join(sizes.select(F.col("conv_id").alias("base"), F.col("n").alias("n_base")), "base", "left")
        .withColumn("taken", taken)
        .select("conv_id", "base", "n", "h", "taken", (F.col("taken") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("length")),
        "trie-plans",
    )
    heads = (
        own.where((F.col("r") < HEADS - 1) & (F.col("conv_id") % FAMILY == 0))
        .withColumnRenamed("conv_id", "base")
        .join(plans.select("conv_id", "base", "taken", "length"), "base")
        .where("r < taken")
        .withColumn("d", F.col("r") + 1)
    )
    tails = skewed_join(own, plans.select("conv_id", "n", "h", "taken", "length"), ["conv_id"], "n", own.count())
    tails = tails.where("r >= h").withColumn("d", F.col("taken") + F.col("r") - F.col("h") + 1)
    columns = ["conv_id", "d", "t", "n_words", (F.col("length") - F.col("d") + 1).alias("rest")]
    return heads.select(*columns).unionByName(tails.select(*columns)), plans.select("conv_id", "length")


def _key(depth: Column, sums: list[Column]) -> Column:
    return F.unhex(F.md5(F.concat_ws(",", depth.cast("string"), *[s.cast("string") for s in sums])))


def prefixes(rows: DataFrame, lengths: DataFrame) -> DataFrame:
    """(conv_id, d, key, pkey, n_words, rest): each conversation's prefixes, the empty one included."""
    hashed = [F.xxhash64(F.lit(k), "d", "t") for k in range(2)]
    parts = [p for x in hashed for p in (F.shiftrightunsigned(x, 32), x.bitwiseAND(0xFFFFFFFF))]
    rows = stored(
        rows.select("*", *[p.alias(f"p{k}") for k, p in enumerate(parts)], F.floor((F.col("d") - 1) / BLOCK).alias("block")),
        "trie-rebuilt",
    )
    within = Window.partitionBy("conv_id", "block").orderBy("d").rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    longer = rows.where("rest + d - 1 > " + str(BLOCK))
    blocks = longer.groupBy("conv_id", "block").agg(*[F.sum(f"p{k}").alias(f"p{k}") for k in range(4)])
    blocks = blocks.select("conv_id", "block", *[F.sum(f"p{k}").over(before).alias(f"b{k}") for k in range(4)]).where("block > 0")
    summed = rows.withColumns({s: F.sum(f"p{k}").over(within) for k, s in enumerate(_SUMS)}).join(blocks, ["conv_id", "block"], "left")
    now = [F.col(s) + F.coalesce(f"b{k}", F.lit(0)) for k, s in enumerate(_SUMS)]
    up = [s - F.col(f"p{k}") for k, s in enumerate(now)]
    nothing = [F.lit(0)] * 4
    keyed = summed.select("conv_id", "d", _key(F.col("d"), now).alias("key"), _key(F.col("d") - 1, up).alias("pkey"), "n_words", "rest")
    top = lengths.select(
        "conv_id",
        F.lit(0).cast("long").alias("d"),
        _key(F.lit(0), nothing).alias("key"),
        F.lit(None).cast("binary").alias("pkey"),
        F.lit(0).cast("long").alias("n_words"),
        (F.col("length") + 1).alias("rest"),
    )
    return stored(keyed.unionByName(top), "trie-prefixes")


def centroid_rollup(parent: np.ndarray, depth: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Sums of ``values`` (n by k) over the subtree of each node of a forest, by centroid decomposition.

    ``parent`` holds -1 for tops; ``depth`` grows by one from parent to child. All trees are split at
    the same time, a round for each level of the decomposition.
    """
    n = len(parent)
    out = np.zeros_like(values)
    if not n:
        return out
    size = np.ones(n, "i8")
    by_depth = np.argsort(depth, kind="stable")
    levels = np.split(by_depth, np.flatnonzero(np.diff(depth[by_depth])) + 1)
    for nodes in reversed(levels):
        inner = nodes[parent[nodes] >= 0]
        np.add.at(size, parent[inner], size[inner])
    whole = size.copy()
    # preorder, so that a subtree is a range of places
    place = np.zeros(n, "i8")
    root = np.arange(n)
    for nodes in levels:
        up = parent[nodes]
        order = np.argsort(up, kind="stable")
        nodes, up = nodes[order], up[order]
        ends = np.cumsum(whole[nodes])
        begin = ends - whole[nodes]
        first = np.flatnonzero(np.r_[True, up[1:] != up[:-1]])
        group = np.repeat(first, np.diff(np.r_[first, len(up)]))
        inner = up >= 0
        place[nodes[inner]] = (place[up] + 1 + begin - begin[group])[inner]
        root[nodes[inner]] = root[up[inner]]
    # tops have places of their own
    tops = np.flatnonzero(parent < 0)
    shift = np.zeros(n, "i8")
    shift[tops] = np.cumsum(whole[tops]) - whole[tops]
    place += shift[root]
    up, tree = parent.copy(), root
    alive = np.argsort(place)
    while len(alive):
        heavy = np.zeros(n, bool)
        heavy[alive] = 2 * size[alive] >= size[tree[alive]]
        deeper = np.zeros(n, bool)
        inner = alive[heavy[alive] & (up[alive] >= 0)]
        deeper[up[inner]] = True
        centroids = alive[heavy[alive] & ~deeper[alive]]
        at = np.full(n, -1, "i8")
        at[tree[centroids]] = centroids
        own = at[tree[alive]]
        below = (place[alive] >= place[own]) & (place[alive] < place[own] + whole[own])
        total = np.zeros((n, values.shape[1]), values.dtype)
        np.add.at(total, own[below], values[alive[below]])
        out[centroids] += total[centroids]
        walk, start = up[centroids], centroids
        while (going := walk >= 0).any():
            walk, start = walk[going], start[going]
            out[walk] += total[start]
            size[walk] -= size[start]
            walk = up[walk]
        # what hangs below a centroid gets the name of its new top: the nearest top before it
        lower = alive[below]
        lower = lower[at[tree[lower]] != lower]
        lower = lower[np.argsort(tree[lower], kind="stable")]
        is_centroid = np.zeros(n, bool)
        is_centroid[centroids] = True
        cut = (up[lower] >= 0) & is_centroid[up[lower]]
        if len(lower):
            tree[lower] = lower[np.flatnonzero(cut)[np.cumsum(cut) - 1]]
            up[lower[cut]] = -1
        alive = alive[~is_centroid[alive]]
    return out


_STATE = ["comp", "key", "pkey", "conv_id", "d", "leaves", "saved", "size", "sum_leaves", "sum_saved"]
_ROLLED = "key binary, sum_leaves long, sum_saved long"


def _rollup_small(state: DataFrame) -> DataFrame:
    """(key, sum_leaves, sum_saved) of components that each fit into a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def rolled(table: pa.Table) -> pa.RecordBatch:
            key = table.column("key").combine_chunks()
            parent = pc.index_in(table.column("pkey").combine_chunks(), value_set=key)
            values = np.stack([table.column(c).to_numpy() for c in ("leaves", "saved")], 1)
            before = np.stack([table.column(c).to_numpy() for c in ("sum_leaves", "sum_saved")], 1)
            sums = before + centroid_rollup(pc.fill_null(parent, -1).to_numpy().astype("i8"), table.column("d").to_numpy(), values)
            return pa.RecordBatch.from_arrays([key, pa.array(sums[:, 0]), pa.array(sums[:, 1])], ["key", "sum_leaves", "sum_saved"])

        for batch in batches:
            held.append(batch)
            if sum(b.num_rows for b in held) < 2 * LOCAL_NODES:
                continue
            table = pa.Table.from_batches(held)
            comp = table.column("comp").combine_chunks()
            # the last component may go on in the next batch
            cut = pc.index(comp, comp[-1]).as_py()
            if cut:
                yield rolled(table.slice(0, cut))
            held = table.slice(cut).to_batches()
        if held:
            yield rolled(pa.Table.from_batches(held))

    ordered = state.select("comp", "key", "pkey", "d", "leaves", "saved", "sum_leaves", "sum_saved")
    return ordered.repartition("comp").sortWithinPartitions("comp").mapInArrow(run, _ROLLED)


def _split(state: DataFrame, comps: DataFrame, total: int, paths: DataFrame) -> tuple[DataFrame, DataFrame]:
    """One round over components too large for a task: (what is left, centroids with their sums)."""
    heavy = skewed_join(state, comps, ["comp"], "n", total).where(2 * F.col("size") >= F.col("weight"))
    centroids = heavy.groupBy("comp").agg(
        F.min(F.struct("size", "key", F.col("conv_id").alias("conv"), F.col("d").alias("depth"))).alias("c")
    )
    centroids = stored(
        centroids.join(comps, "comp").select(
            "comp", "n", "top", F.col("c.key").alias("c_key"), F.col("c.conv").alias("c_conv"), F.col("c.depth").alias("c_d"), F.col("c.size").alias("c_size")
        ),
        "trie-centroids",
    )
    told = stored(skewed_join(state, centroids.select("comp", "n", "c_key", "c_d"), ["comp"], "n", total), "trie-told")
    # a node is below the centroid if its own conversation goes through it; its new top is the next node there
    asked = told.where("d > c_d").groupBy("comp", "conv_id", "c_key", "c_d").agg(F.count(F.lit(1)).alias("n"))
    next_ = paths.select("conv_id", (F.col("d") - 1).alias("c_d"), F.col("pkey").alias("c_key"), F.col("key").alias("child"))
    answers = stored(asked.join(next_, ["conv_id", "c_d", "c_key"], "left").select("comp", "conv_id", "n", "child"), "trie-answers")
    named = skewed_join(told.where("d > c_d"), answers, ["comp", "conv_id"], "n", total)
    named = stored(named.unionByName(told.where("d <= c_d").withColumn("child", F.lit(None).cast("binary"))), "trie-named")
    sums = named.where(F.col("child").isNotNull() | (F.col("key") == F.col("c_key"))).groupBy("comp")
    sums = sums.agg(F.sum("leaves").alias("t_leaves"), F.sum("saved").alias("t_saved"))
    sums = stored(centroids.join(sums, "comp"), "trie-sums")
    way = (
        paths.select(F.col("conv_id").alias("c_conv"), "d", "key")
        .join(sized_broadcast(sums, 200, sums.count()), "c_conv")
        .where("d < c_d and d >= top")
        .select("comp", "key", "t_leaves", "t_saved", "c_size")
    )
    # the centroid itself is the end of its path
    way = way.unionByName(sums.select("comp", F.col("c_key").alias("key"), "t_leaves", "t_saved", F.lit(0).cast("long").alias("c_size")))
    added = stored(
        named.join(way, ["comp", "key"], "left").select(
            F.coalesce("child", "comp").alias("comp"),
            *["key", "pkey", "conv_id", "d", "leaves", "saved"],
            (F.col("size") - F.coalesce("c_size", F.lit(0))).alias("size"),
            (F.col("sum_leaves") + F.coalesce("t_leaves", F.lit(0))).alias("sum_leaves"),
            (F.col("sum_saved") + F.coalesce("t_saved", F.lit(0))).alias("sum_saved"),
            (F.col("key") == F.col("c_key")).alias("gone"),
        ),
        "trie-split",
    )
    return added.where("not gone").select(*_STATE), added.where("gone").select("key", "sum_leaves", "sum_saved")


def rollup(nodes: DataFrame, paths: DataFrame, local_nodes: int = LOCAL_NODES) -> DataFrame:
    """(key, sum_leaves, sum_saved): sums of ``leaves`` and ``saved`` over each node's subtree.

    ``nodes`` has key, pkey, conv_id and d (a member and the depth), size (a weight of one or more, summed
    over the subtree), leaves and saved; ``paths`` has the prefixes of the members.
    """
    zero = F.lit(0).cast("long")
    # stored, as a constant component would turn the joins by component into nested loops
    state = stored(nodes.withColumns({"comp": F.lit(b"").cast("binary"), "sum_leaves": zero, "sum_saved": zero}).select(*_STATE), "trie-state")
    small, done = [], []
    while True:
        comps = stored(
            state.groupBy("comp").agg(F.count(F.lit(1)).alias("n"), F.max("size").alias("weight"), F.min("d").alias("top")), "trie-comps"
        )
        large = comps.where(F.col("n") > local_nodes)
        held = large.agg(F.sum("n")).first()[0]
        if not held:
            small.append(state)
            break
        few = comps.where(F.col("n") <= local_nodes).select("comp", "n")
        total = comps.agg(F.sum("n")).first()[0]
        small.append(skewed_join(state, few, ["comp"], "n", total))
        state, gone = _split(skewed_join(state, large.select("comp", "n"), ["comp"], "n", total), large, held, paths)
        done.append(gone)
    out = None
    for part in small:
        out = part if out is None else out.unionByName(part)
    out = _rollup_small(out)
    for part in done:
        out = out.unionByName(part)
    return out


def ends(paths: DataFrame) -> DataFrame:
    """(key, ends_sha256) of the nodes where conversations end: their ids ascending, comma-joined."""

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, first, ids, size = None, 0, [], 0

        def piece() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([key], pa.binary()), pa.array([first]), pa.array([",".join(ids)])], ["key", "first", "ids"])

        for batch in batches:
            for now, conv in zip(batch.column("key").to_pylist(), batch.column("conv_id").to_pylist()):
                if ids and (now != key or size >= PIECE_BYTES):
                    yield piece()
                    ids, size = [], 0
                if not ids:
                    key, first = now, conv
                ids.append(str(conv))
                size += len(ids[-1]) + 1
        if ids:
            yield piece()

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state, done = None, None, []

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([k for k, _ in done], pa.binary()), pa.array([d for _, d in done])], ["key", "ends_sha256"])

        for batch in batches:
            for now, ids in zip(batch.column("key").to_pylist(), batch.column("ids").to_pylist()):
                if now == key:
                    state.update(b",")
                else:
                    if key is not None:
                        done.append((key, state.hexdigest()))
                    key, state = now, hashlib.sha256()
                state.update(ids.encode())
            if len(done) >= 4096:
                yield out()
                done = []
        if key is not None:
            done.append((key, state.hexdigest()))
            yield out()

    last = paths.where("rest = 1").select("key", "conv_id")
    made = last.repartitionByRange("key", "conv_id").sortWithinPartitions("key", "conv_id").mapInArrow(pieces, "key binary, first long, ids string")
    return made.repartition("key").sortWithinPartitions("key", "first").mapInArrow(hashed, "key binary, ends_sha256 string")


def conversation_trie(conversations: DataFrame, local_nodes: int = LOCAL_NODES) -> DataFrame:
    """A row for each node of the prefix trie of the rebuilt conversations (see ``rebuilt``).

    A node is a distinct sequence of first d turns, equal in role and text; the root is the empty one.
    Its members are the conversations that begin with it. conv_id: the smallest member; depth;
    parent_conv_id: the smallest member of the parent (null for the root); n_convs: members; n_children;
    n_leaves: nodes without children in the subtree, its top included; saved_tokens: over the subtree, for
    each node its members but one, times the words of its last text; ends_sha256: SHA-256 of the ids of
    the members that have d turns.

    Null role and text are empty. Rows equal in turn are ordered by role and text; repeated rows are turns of their own.
    Rows without a conv_id are left out. No conversations give no nodes. Other columns are not read.
    """
    rows, lengths = rebuilt(conversations)
    paths = prefixes(rows, lengths)
    members = paths.groupBy("key").agg(
        F.min("conv_id").alias("conv_id"),
        F.max("d").alias("d"),
        F.max("pkey").alias("pkey"),
        F.count(F.lit(1)).alias("n_convs"),
        F.max("n_words").alias("n_words"),
        F.sum("rest").alias("size"),
    )
    members = stored(members, "trie-members")
    children = members.where("pkey is not null").groupBy(F.col("pkey").alias("key")).agg(F.count(F.lit(1)).alias("n_children"))
    nodes = members.join(children, "key", "left").na.fill(0, ["n_children"])
    nodes = stored(
        nodes.select(
            "*",
            (F.col("n_children") == 0).cast("long").alias("leaves"),
            ((F.col("n_convs") - 1) * F.col("n_words")).alias("saved"),
        ),
        "trie-nodes",
    )
    sums = rollup(nodes.select("key", "pkey", "conv_id", "d", "size", "leaves", "saved"), paths, local_nodes)
    above = nodes.where("n_children > 0").select(F.col("key").alias("pkey"), F.col("conv_id").alias("parent_conv_id"), "n_children")
    columns = ["key", "pkey", "conv_id", "d", "n_convs", F.col("n_children").alias("n_own")]
    named = skewed_join(nodes.where("d > 0").select(*columns), above, ["pkey"], "n_children", nodes.count())
    top = nodes.where("d = 0").select(*columns, F.lit(None).cast("long").alias("parent_conv_id"))
    return (
        named.unionByName(top)
        .join(sums, "key")
        .join(ends(paths), "key", "left")
        .select(
            "conv_id",
            F.col("d").alias("depth"),
            "parent_conv_id",
            "n_convs",
            F.col("n_own").alias("n_children"),
            F.col("sum_leaves").alias("n_leaves"),
            F.col("sum_saved").alias("saved_tokens"),
            F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
        )
    )
