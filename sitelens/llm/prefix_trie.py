"""Prefix tree of conversations, built as a z-fast trie.

A conversation is a sequence of turns. A prefix of ``d`` turns is known by its signature: the xor of
two 64-bit hashes of each turn with its place. The compacted tree has a node wherever conversations
part or end; its edge covers the depths ``(parent, depth]``. A node is hashed at its handle, the
depth in that range that the highest power of two divides. A conversation's exit node is found by
fat binary search: for each power of two, from the highest down, one prefix of the conversation at
most is looked up among the handles, and the range of depths left shrinks. All conversations of a
batch do a step of the search together, in one join. A batch is then inserted below its exit nodes:
prefixes there that have two different next turns, or end, become nodes, and edges they lie on are
cut. Members, leaves and savings are sums over a node's conversations, taken at compacted nodes only;
edges are expanded to a row for each depth at the end.

Turns are numbered, and prefixes hashed, in ranges, so that one conversation of any length is dealt
over many tasks. Equal conversations are inserted once. The ids that end at a node are hashed from
blocks of a few thousand, so that no list of them is ever whole anywhere.

Defined results: rows without a conv_id take no part; null roles and texts are empty; a null turn
comes first. Rows with equal conv_id and turn are ordered by role, by the text's first 64
characters, then by a hash of the text; all of them are turns. ``c % 5`` has the sign of ``c``.
An empty table has no nodes. Other columns are ignored, whatever their names.
"""

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sitelens.llm.common import spread, stored
from sitelens.operators.overlap import explode_range

#: Turns of one block of running signatures, as a power of two.
BLOCK_BITS = 12
#: Ids of one block of a node's list.
LISTED = 4096
#: Batches in which conversations are inserted; each takes about as many as all before it.
BATCHES = 3
#: Steps of the search that go into one plan.
STEPS = 6

_SIGN = ["s1", "s2"]
_NODE = "depth long, s1 long, s2 long, parent long, rep long, handle long, h1 long, h2 long, n1 long, n2 long"


def numbered_turns(conversations: DataFrame) -> DataFrame:
    """``conv_id, pos, t1, t2, size``: each turn's place from 1, two hashes, bytes of its text.

    Turns are sorted over all conversations in ranges; a place is the row's place in its range plus
    the conversation's turns in earlier ranges.
    """
    role, text = (F.coalesce(conversations[c], F.lit("")) for c in ("role", "text"))
    turns = conversations.where(conversations["conv_id"].isNotNull()).select(
        conversations["conv_id"].cast("long").alias("conv_id"),
        conversations["turn"].alias("turn"),
        role.alias("role"),
        F.substring(text, 1, 64).alias("head"),
        F.xxhash64(F.lit(1), role, text).alias("t1"),
        F.xxhash64(F.lit(2), role, text).alias("t2"),
        F.octet_length(text).cast("long").alias("size"),
        # equal rows may lie in several ranges
        F.monotonically_increasing_id().alias("salt"),
    )
    order = ["conv_id", "turn", "role", "head", "t1", "salt"]
    placed = turns.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = stored(
        placed.select("conv_id", "t1", "t2", "size", F.monotonically_increasing_id().alias("place")),
        "placed-turns",
    ).withColumn("range", F.shiftright("place", 33))
    earlier = Window.partitionBy("conv_id").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    parts = placed.groupBy("conv_id", "range").agg(F.min("place").alias("first"), F.count("*").alias("n"))
    shift = F.coalesce(F.sum("n").over(earlier), F.lit(0)) + 1 - F.col("first")
    parts = parts.select("conv_id", "range", shift.alias("shift"))
    pos = (F.col("place") + F.col("shift")).alias("pos")
    return placed.join(parts, ["conv_id", "range"]).select("conv_id", pos, "t1", "t2", "size")


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Conversations that share heads: their ids, and their turns ``conv_id, d, t1, t2, size``.

    Conversation ``c`` begins with the first ``h`` turns of ``c - c % 5``, where ``h`` is the crc32
    of its id as text modulo 9, and goes on with its own turns after its first ``h``.
    """
    turns = stored(turns, "turns")
    lengths = turns.groupBy("conv_id").agg(F.max("pos").alias("n"))
    head = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % 9).cast("long")
    ids = lengths.select(
        "conv_id", (F.col("conv_id") - F.col("conv_id") % 5).alias("base"), head.alias("h")
    )
    bases = lengths.select(F.col("conv_id").alias("base"), F.col("n").alias("base_n"))
    shared = F.least("h", F.coalesce("base_n", F.lit(0)))
    own = (
        turns.withColumns({"base": F.col("conv_id") - F.col("conv_id") % 5, "h": head})
        .where("pos > h")
        .join(bases, "base", "left")
        .select("conv_id", (F.col("pos") - F.col("h") + shared).alias("d"), "t1", "t2", "size")
    )
    heads = (
        turns.where("pos <= 8")
        .withColumnRenamed("conv_id", "base")
        .join(ids, "base")
        .where("pos <= h")
        .select("conv_id", F.col("pos").alias("d"), "t1", "t2", "size")
    )
    return lengths.select("conv_id"), own.unionByName(heads)


def prefixes(turns: DataFrame) -> DataFrame:
    """``turns`` with the signatures of the prefix that each one ends (``s1, s2``) and of the one
    before it (``q1, q2``), and the bytes up to its end (``upto``)."""
    mixed = turns.withColumns(
        {
            "t1": F.xxhash64(F.lit(3), "d", "t1"),
            "t2": F.xxhash64(F.lit(4), "d", "t2"),
            "block": F.shiftright("d", BLOCK_BITS),
        }
    )
    inside = Window.partitionBy("conv_id", "block").orderBy("d").rowsBetween(Window.unboundedPreceding, 0)
    earlier = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    whole = mixed.groupBy("conv_id", "block").agg(
        F.bit_xor("t1").alias("b1"), F.bit_xor("t2").alias("b2"), F.sum("size").alias("b3")
    )
    before = whole.select(
        "conv_id",
        "block",
        F.bit_xor("b1").over(earlier).alias("b1"),
        F.bit_xor("b2").over(earlier).alias("b2"),
        F.sum("b3").over(earlier).alias("b3"),
    ).where("block > 0 and b1 is not null")
    running = mixed.withColumns(
        {
            "s1": F.bit_xor("t1").over(inside),
            "s2": F.bit_xor("t2").over(inside),
            "upto": F.sum("size").over(inside),
        }
    ).join(before, ["conv_id", "block"], "left")
    return running.selectExpr(
        "conv_id",
        "d",
        "s1 ^ coalesce(b1, 0) as s1",
        "s2 ^ coalesce(b2, 0) as s2",
        "s1 ^ coalesce(b1, 0) ^ t1 as q1",
        "s2 ^ coalesce(b2, 0) ^ t2 as q2",
        "size",
        "upto + coalesce(b3, 0) as upto",
    )


def sequences(ids: DataFrame, paths: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Distinct sequences and the conversations that are one.

    First ``rep, length, s1, s2, total, m``: the smallest conversation, its turns, signature and
    bytes, and how many are equal. Then ``rep, conv_id`` of every conversation.
    """
    last = paths.groupBy("conv_id").agg(
        F.max(F.struct("d", "s1", "s2", "upto")).alias("end"),
    )
    ends = ids.join(last, "conv_id", "left").selectExpr(
        "conv_id",
        *(f"coalesce(end.{a}, 0L) as {b}" for a, b in (("d", "length"), ("s1", "s1"), ("s2", "s2"), ("upto", "total"))),
    )
    ends = stored(ends, "ends")
    same = ["length", *_SIGN, "total"]
    found = stored(
        ends.groupBy(*same).agg(F.min("conv_id").alias("rep"), F.count("*").alias("m")), "sequences"
    )
    return found, ends.join(found.hint("merge"), same).select("rep", "conv_id")


def fattest(low: Column, high: Column) -> Column:
    """The number in ``(low, high]`` that the highest power of two divides."""
    bits = F.length(F.bin(low.bitwiseXOR(high))) - 1
    power = F.call_function("shiftleft", F.lit(1).cast("long"), bits)
    return F.call_function("shiftright", high, bits) * power


def _level(depth: Column, level: int) -> Column:
    """Whether 2 ** level is the highest power of two that divides ``depth``."""
    return depth.bitwiseAND((1 << (level + 1)) - 1) == (1 << level)


def locate(nodes: DataFrame, paths: DataFrame, keys: DataFrame, longest: int) -> DataFrame:
    """Exit nodes of the sequences ``keys`` (``rep, length``), whose prefixes are in ``paths``.

    ``rep, length, start``, and of the edge in which the sequence leaves the tree ``edge, e1, e2,
    edge_rep`` (null where it starts an edge of its own below depth ``start``).
    """
    zero = F.lit(0).cast("long")
    state = keys.select(
        "rep", "length", zero.alias("low"), F.col("length").alias("high"), zero.alias("low_parent"),
        *(zero.alias(c) for c in ("e1", "e2", "edge_rep")),
    )
    for done, level in enumerate(reversed(range(longest.bit_length())), 1):
        probes = paths.where(_level(F.col("d"), level)).select(
            F.col("rep").alias("asked"), "d", *_SIGN
        )
        # one prefix at most: the range holds one multiple of this power
        here = (F.col("rep") == F.col("asked")) & (F.col("d") > F.col("low")) & (F.col("d") <= F.col("high"))
        asked = state.join(probes, here, "left")
        handles = nodes.where(_level(F.col("handle"), level)).select(
            F.col("handle").alias("d"), F.col("h1").alias("s1"), F.col("h2").alias("s2"),
            F.col("depth").alias("hit"), F.col("parent").alias("hit_parent"),
            F.col("s1").alias("hit1"), F.col("s2").alias("hit2"), F.col("rep").alias("hit_rep"),
        )
        state = asked.join(handles, ["d", *_SIGN], "left").selectExpr(
            "rep",
            "length",
            "coalesce(hit, low) as low",
            "if(d is not null and hit is null, d - 1, high) as high",
            "coalesce(hit_parent, low_parent) as low_parent",
            "coalesce(hit1, e1) as e1",
            "coalesce(hit2, e2) as e2",
            "if(hit is null, edge_rep, hit_rep) as edge_rep",
        )
        if done % STEPS == 0:
            state = stored(state, "search")
    state = stored(state, "found")
    # the last node found lies on the path, or the path leaves its edge
    at = paths.select("rep", F.col("d").alias("low"), F.col("s1").alias("e1"), F.col("s2").alias("e2"))
    on = state.where("low > 0").join(at, ["rep", "low", "e1", "e2"], "left_semi")
    on = on.unionByName(state.where("low = 0"))
    off = state.where("low > 0").join(at, ["rep", "low", "e1", "e2"], "left_anti")
    names = nodes.select(
        (F.col("parent") + 1).alias("d"), F.col("n1").alias("s1"), F.col("n2").alias("s2"),
        F.col("depth").alias("edge"), F.col("s1").alias("e1"), F.col("s2").alias("e2"),
        F.col("rep").alias("edge_rep"),
    )
    below = on.select("rep", "length", (F.col("low") + 1).alias("d"), F.col("low").alias("start"))
    below = below.join(paths.select("rep", "d", *_SIGN), ["rep", "d"], "left")
    below = below.join(names, ["d", *_SIGN], "left")
    columns = ["rep", "length", "start", "edge", "e1", "e2", "edge_rep"]
    off = off.withColumnsRenamed({"low_parent": "start", "low": "edge"})
    return stored(below.select(*columns).unionByName(off.select(*columns)), "exits")


def insert(nodes: DataFrame | None, paths: DataFrame, keys: DataFrame, longest: int) -> DataFrame:
    """The nodes after a batch ``keys`` of sequences came in; ``paths`` holds all prefixes of these
    and of all before them. Sequences that are there already change nothing."""
    if nodes is None:
        nodes = paths.sparkSession.createDataFrame([], _NODE)
        starts = keys.select("rep", "length", F.lit(0).cast("long").alias("start"))
        cut = None
    else:
        exits = locate(nodes, paths, keys, longest)
        starts = exits.select("rep", "length", "start")
        cut = exits.where("edge is not null").select(
            F.col("edge").alias("depth"), F.col("e1").alias("s1"), F.col("e2").alias("s2"),
            F.col("edge_rep").alias("rep"), "start",
        ).distinct()
        cut = stored(cut, "cut-edges")
    # what lies below the exits: the batch's prefixes, and the edges that they leave
    rows = ["rep", "start", "d", *_SIGN, "q1", "q2"]
    new = paths.join(starts, "rep").where("d > start")
    ends = new.where("d = length").select(F.col("d").alias("depth"), *_SIGN)
    region = new.select(*rows)
    if cut is not None:
        edges = cut.select("rep", "start", F.col("depth").alias("edge"))
        old = paths.join(edges, "rep").where("d > start and d <= edge")
        region = region.unionByName(old.select(*rows))
        ends = ends.unionByName(cut.select("depth", *_SIGN))
    region = stored(region, "region")
    step = F.struct("s1", "s2")
    parted = region.groupBy((F.col("d") - 1).alias("depth"), "q1", "q2", "start").agg(
        F.min(step).alias("a"), F.max(step).alias("b")
    )
    # at depth start there is a node already
    parted = parted.where("a != b and depth > start").select(
        "depth", F.col("q1").alias("s1"), F.col("q2").alias("s2")
    )
    marks = stored(ends.unionByName(parted).distinct(), "marks").withColumnRenamed("depth", "d")
    along = Window.partitionBy("rep", "start").orderBy("d")
    placed = stored(region.select("rep", "start", "d", *_SIGN).distinct().join(marks, ["d", *_SIGN]), "marked")
    placed = placed.withColumn("parent", F.coalesce(F.lag("d").over(along), "start"))
    made = placed.groupBy(F.col("d").alias("depth"), *_SIGN).agg(
        F.max("parent").alias("parent"), F.min("rep").alias("rep")
    )
    made = made.withColumn("handle", fattest(F.col("parent"), F.col("depth")))
    signs = paths.select("rep", "d", *_SIGN)
    for depth, a, b in ((F.col("handle"), "h1", "h2"), (F.col("parent") + 1, "n1", "n2")):
        here = signs.withColumnsRenamed({"s1": a, "s2": b})
        made = made.withColumn("d", depth).join(here, ["rep", "d"]).drop("d")
    if cut is not None:
        kept = nodes.join(cut, ["depth", *_SIGN], "left_anti")
        made = kept.unionByName(made.select(*kept.columns))
    return stored(made.select(*nodes.columns), "nodes")


def compacted(paths: DataFrame, found: DataFrame, batches: int = BATCHES) -> DataFrame:
    """The compacted tree of the sequences ``found``, inserted in batches by a hash of their names.

    ``paths`` holds the prefixes of ``found`` only, as ``rep`` and columns of ``prefixes``.
    """
    longest = found.agg(F.max("length")).first()[0] or 0
    part = spread(F.col("rep"), 1 << (batches - 1))
    # one part first, then one more, two more, four more
    batch = F.when(part == 0, 0).otherwise(F.length(F.bin(part.cast("long"))))
    keys = found.where("length > 0").select("rep", "length", batch.alias("batch"))
    nodes = None
    for number in range(batches):
        own = keys.where(F.col("batch") == number).drop("batch")
        nodes = insert(nodes, paths, own, longest)
    return nodes


def list_hashes(members: DataFrame) -> DataFrame:
    """``rep, ends_sha256`` of ``rep, conv_id``: SHA-256 of each one's ids, ascending, by commas."""

    def blocks(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            own = part.groupby((part["rep"].diff() != 0).cumsum())
            rows = [
                (run["rep"].iloc[0], ids.iloc[0], ",".join(map(str, ids)))
                for _, run in own
                for ids in (run["conv_id"].iloc[i : i + LISTED] for i in range(0, len(run), LISTED))
            ]
            yield pd.DataFrame(rows, columns=["rep", "first", "ids"])

    def hashes(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rep, state = None, None
        for part in parts:
            done = []
            for r, ids in zip(part["rep"], part["ids"], strict=True):
                if r != rep:
                    if state:
                        done.append((rep, state.hexdigest()))
                    rep, state = r, hashlib.sha256(ids.encode())
                else:
                    state.update(("," + ids).encode())
            yield pd.DataFrame(done, columns=["rep", "ends_sha256"])
        if state:
            yield pd.DataFrame([(rep, state.hexdigest())], columns=["rep", "ends_sha256"])

    ranged = members.repartitionByRange("rep", "conv_id").sortWithinPartitions("rep", "conv_id")
    runs = stored(ranged.mapInPandas(blocks, "rep long, first long, ids string"), "id-blocks")
    dealt = runs.repartition("rep").sortWithinPartitions("rep", "first")
    return dealt.mapInPandas(hashes, "rep long, ends_sha256 string")


def prefix_tree(conversations: DataFrame, batches: int = BATCHES) -> DataFrame:
    """A row for each node of the tree of rebuilt conversations, all longs but the hash.

    ``conv_id`` (smallest member), ``depth``, ``parent_conv_id``, ``n_convs``, ``n_children``,
    ``n_leaves``, ``saved_tokens`` (bytes that sharing saves below and at the node) and
    ``ends_sha256`` (of the ids that end there).
    """
    ids, turns = rebuilt(numbered_turns(conversations))
    every = stored(prefixes(turns), "prefixes")
    found, members = sequences(ids, every)
    copies = found.select(F.col("rep").alias("conv_id"), "m", "total")
    paths = stored(every.join(copies, "conv_id").withColumnRenamed("conv_id", "rep"), "paths")
    nodes = compacted(paths, found, batches)
    return expanded(nodes, paths, found, members)


def expanded(nodes: DataFrame, paths: DataFrame, found: DataFrame, members: DataFrame) -> DataFrame:
    """Figures of all nodes, summed at compacted ones and carried along their edges."""
    key = ["depth", *_SIGN]
    # a row for each sequence and compacted node on its path
    on = paths.join(nodes.select(F.col("depth").alias("d"), *_SIGN).hint("merge"), ["d", *_SIGN])
    on = stored(on.select("rep", F.col("d").alias("depth"), *_SIGN, "upto", "m", "total"), "on-path")
    along = Window.partitionBy("rep").orderBy("depth")
    above = {f"p_{c}": F.lag(c, 1, 0).over(along) for c in (*key, "upto")}
    on = stored(on.withColumns(above), "with-parents")
    sums = on.groupBy(*key).agg(
        F.min("rep").alias("owner"), F.sum("m").alias("n"), F.sum(F.col("m") * F.col("total")).alias("held")
    )
    sums = stored(sums, "node-sums")
    # each node is its smallest sequence's own; so every edge's bytes count once
    owned = on.withColumnRenamed("rep", "owner").join(sums.select("owner", *key), ["owner", *key])
    owned = stored(owned.select("owner", *key, *above, "total", "upto"), "owned")
    children = owned.groupBy(*(F.col(f"p_{c}").alias(c) for c in key)).agg(F.count("*").alias("n_children"))
    children = stored(children, "children")
    edges = owned.groupBy(F.col("owner").alias("rep")).agg(
        F.sum(F.col("upto") - F.col("p_upto")).alias("own")
    )
    inner = children.select(F.col("depth").alias("length"), *_SIGN, F.lit(0).cast("long").alias("leaf"))
    shares = found.join(inner, ["length", *_SIGN], "left").join(edges, "rep", "left")
    shares = shares.selectExpr("rep", "length", *_SIGN, "total", "m", "coalesce(leaf, 1L) as leaf", "coalesce(own, 0L) as own")
    shares = stored(shares, "shares")
    below = on.select("rep", *key).join(shares.select("rep", "leaf", "own"), "rep")
    below = below.groupBy(*key).agg(F.sum("leaf").alias("n_leaves"), F.sum("own").alias("own_below"))
    mine = shares.select(F.col("rep").alias("owner"), "own")
    hashes = list_hashes(members).join(found.select("rep", F.col("length").alias("depth"), *_SIGN), "rep")
    hashes = stored(hashes.drop("rep"), "end-hashes")
    above_owner = sums.select(*(F.col(c).alias(f"p_{c}") for c in key), F.col("owner").alias("up"))
    every = found.agg(F.min("rep").alias("up")).select(
        *(F.lit(0).cast("long").alias(f"p_{c}") for c in key), "up"
    )
    figures = (
        owned.join(sums.drop("owner"), key)
        .join(below, key)
        .join(mine, "owner")
        .join(children, key, "left")
        .join(hashes, key, "left")
        .join(above_owner.unionByName(every), [f"p_{c}" for c in key])
        .select(
            "owner", *key, F.col("p_depth").alias("p"), "up", "n", "n_children", "n_leaves", "ends_sha256",
            # members' bytes, less those of the distinct texts below the path's own
            (F.col("held") - F.col("own_below") + F.col("own") - F.col("total")).alias("rest"),
        )
    )
    nothing = F.lit(hashlib.sha256(b"").hexdigest())
    rows = explode_range(figures, "d", F.col("p") + 1, F.col("depth"))
    walked = paths.select(F.col("rep").alias("owner"), "d", (F.col("upto") - F.col("size")).alias("before"))
    last = F.col("d") == F.col("depth")
    inner_rows = rows.join(walked, ["owner", "d"]).select(
        F.col("owner").alias("conv_id"),
        F.col("d").alias("depth"),
        F.when(F.col("d") == F.col("p") + 1, F.col("up")).otherwise(F.col("owner")).alias("parent_conv_id"),
        F.col("n").alias("n_convs"),
        F.when(last, F.coalesce("n_children", F.lit(0))).otherwise(1).cast("long").alias("n_children"),
        "n_leaves",
        (F.col("rest") - (F.col("n") - 1) * F.col("before")).alias("saved_tokens"),
        F.when(last, F.coalesce("ends_sha256", nothing)).otherwise(nothing).alias("ends_sha256"),
    )
    tops = [
        shares.select(
            F.col("rep").alias("conv_id"), "m", F.when(F.col("length") > 0, F.col("leaf")).alias("leaf"),
            (F.col("m") * F.col("total") - F.col("own")).alias("saved"),
        ),
        children.where("depth = 0").select(F.col("n_children").alias("below")),
        hashes.where("depth = 0").select("ends_sha256"),
    ]
    top = tops[0].unionByName(tops[1], True).unionByName(tops[2], True)
    root = top.agg(
        F.min("conv_id").alias("conv_id"),
        F.lit(0).cast("long").alias("depth"),
        F.lit(None).cast("long").alias("parent_conv_id"),
        F.sum("m").alias("n_convs"),
        F.coalesce(F.sum("below"), F.lit(0)).cast("long").alias("n_children"),
        F.coalesce(F.sum("leaf"), F.lit(1)).cast("long").alias("n_leaves"),
        F.sum("saved").alias("saved_tokens"),
        F.coalesce(F.max("ends_sha256"), nothing).alias("ends_sha256"),
    ).where("conv_id is not null")
    return root.unionByName(inner_rows)
