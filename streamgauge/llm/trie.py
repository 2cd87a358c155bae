"""Prefix tree of conversations, by ROLLUP over the turns at fixed places."""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from streamgauge.llm.common import stored
from streamgauge.operators.ranges import row_numbers

#: Turns in one block of columns, and blocks in one chunk of a conversation.
WIDTH, CHUNK = 8, 64
#: Members whose ids are joined to one piece of text before pieces are hashed in order.
PIECE = 4096

ROOT = ""


def placed_turns(conversations: DataFrame) -> DataFrame:
    """``conv_id``, ``place`` from 0 (by turn, null first), ``turn_id`` and ``n_bytes`` of the text.

    ``turn_id`` names role and text together: 128 bits of their SHA-256. Null role or
    text counts as empty; of equal turn numbers the smaller turn_id comes first.
    Rows without conv_id belong to no conversation and are left out.
    """
    role, text = F.coalesce(F.col("role").cast("string"), F.lit("")), F.coalesce(F.col("text").cast("string"), F.lit(""))
    name = F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256)
    turns = conversations.filter("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", F.substring(name, 1, 32).alias("turn_id"), F.octet_length(text).cast("long").alias("n_bytes")
    )
    return row_numbers(turns, ["conv_id"], ["turn", "turn_id"], "place").drop("turn")


def grafted(placed: DataFrame, root: Column, taken: Column) -> tuple[DataFrame, DataFrame]:
    """Conversations whose first ``taken`` turns are those of the conversation ``root``, and all their ids.

    Both are functions of ``conv_id``. A conversation keeps its own turns after its
    first ``taken``; a shorter or absent root gives what it has. A conversation may lose all turns.
    """
    sizes = stored(placed.groupBy("conv_id").agg((F.max("place") + 1).alias("size")), "conversation_sizes")
    wanted = sizes.select("conv_id", root.alias("root"), taken.alias("taken")).filter("taken > 0")
    most = wanted.agg(F.max("taken")).scalar()
    heads = placed.filter(F.col("place") < most).withColumnRenamed("conv_id", "root")
    borrowed = heads.join(wanted, "root").filter("place < taken").select("conv_id", "place", "turn_id", "n_bytes")
    have = sizes.select(F.col("conv_id").alias("root"), F.col("size").alias("root_size"))
    short = wanted.join(have, "root", "left").select("conv_id", (F.col("taken") - F.coalesce("root_size", F.lit(0))).alias("gap")).filter("gap > 0")
    own = placed.filter(F.col("place") >= taken).join(short, "conv_id", "left")
    own = own.select("conv_id", (F.col("place") - F.coalesce("gap", F.lit(0))).alias("place"), "turn_id", "n_bytes")
    return borrowed.unionByName(own), sizes.select("conv_id")


def _joined(turns: Column) -> Column:
    return F.array_join(F.transform(turns, lambda t: t["turn_id"]), "")


def _digest(*parts: Column) -> Column:
    return F.sha2(F.concat_ws("/", *parts), 256)


def _chunk_prefixes(chunks: DataFrame) -> DataFrame:
    """``before`` and ``after``: names of the turns of all chunks before, and of these with the chunk itself.

    ``chunks`` has ``conv_id``, ``chunk`` and ``digest`` (null where the chunk is not full).
    As within a chunk, 64 at a time: what comes before a group of chunks is one name,
    found the same way one level up. So no window holds more than a group.
    """
    group = F.floor(F.col("chunk") / CHUNK)
    rows = chunks.withColumn("group", group)
    inside = Window.partitionBy("conv_id", "group").orderBy("chunk")
    before, upto = inside.rowsBetween(Window.unboundedPreceding, -1), inside.rowsBetween(Window.unboundedPreceding, 0)
    if chunks.agg(F.max("chunk")).first()[0] >= CHUNK:
        full = rows.groupBy("conv_id", "group").agg(F.count("digest").alias("n"), F.sort_array(F.collect_list(F.struct("chunk", "digest"))).alias("all"))
        digest = F.when(F.col("n") == CHUNK, _digest(F.array_join(F.transform("all", lambda c: c["digest"]), "")))
        above = _chunk_prefixes(full.select("conv_id", F.col("group").alias("chunk"), digest.alias("digest")))
        rows = rows.join(above.select("conv_id", F.col("chunk").alias("group"), F.col("before").alias("start"), F.col("after").alias("end")), ["conv_id", "group"])
    else:
        rows = rows.withColumns({"start": F.lit(ROOT), "end": F.lit(None).cast("string")})
    listed = F.array_join(F.collect_list("digest").over(before), "")
    whole = F.array_join(F.collect_list("digest").over(upto), "")
    last = F.col("chunk") % CHUNK == CHUNK - 1
    return rows.select(
        "conv_id",
        "chunk",
        F.when(F.col("chunk") % CHUNK == 0, F.col("start")).otherwise(_digest(F.col("start"), listed)).alias("before"),
        F.when(F.col("digest").isNotNull(), F.when(last & F.col("end").isNotNull(), F.col("end")).otherwise(_digest(F.col("start"), whole))).alias("after"),
    )


def turn_blocks(placed: DataFrame) -> DataFrame:
    """A row for each block of a conversation: turns ``t1`` .. ``t8``, ``start`` (turns before it) and names.

    ``prev`` names all turns before the block, ``after`` those up to its end (null
    if it is not full). ``last`` marks a conversation's last block. A conversation
    is cut into chunks before anything is gathered, so a task never holds more than
    512 turns of it together; names of chunks add up over windows of 64 rows.
    """
    size = WIDTH * CHUNK
    turns = F.sort_array(F.collect_list(F.struct("place", "turn_id", "n_bytes")))
    chunks = stored(placed.groupBy("conv_id", F.floor(F.col("place") / size).alias("chunk")).agg(turns.alias("turns")), "turn_chunks")
    several = (chunks.agg(F.max("chunk")).first()[0] or 0) > 0
    if several:
        digest = F.when(F.size("turns") == size, _digest(_joined(F.col("turns"))))
        names = _chunk_prefixes(chunks.select("conv_id", "chunk", digest.alias("digest")))
        ends = chunks.groupBy("conv_id").agg(F.max("chunk").alias("last_chunk"))
        chunks = chunks.join(names, ["conv_id", "chunk"]).join(ends, "conv_id")
    else:
        chunks = chunks.withColumns({"before": F.lit(ROOT), "after": F.lit(None).cast("string"), "last_chunk": F.col("chunk")})
    # The chunk's own name where the block ends it: the next chunk begins with it.
    blocks = chunks.select("conv_id", "chunk", "turns", "before", "after", "last_chunk", F.explode(F.sequence(F.lit(0), F.floor((F.size("turns") - 1) / WIDTH))).alias("b"))

    def upto(n: Column) -> Column:
        return F.when(n == 0, F.col("before")).otherwise(_digest(F.col("before"), _joined(F.slice("turns", F.lit(1), n.cast("int")))))

    first, full = F.col("b") * WIDTH, F.size("turns") >= (F.col("b") + 1) * WIDTH
    closes = (F.col("b") == CHUNK - 1) & F.col("after").isNotNull()
    slots = [F.get("turns", (first + i).cast("int")) for i in range(WIDTH)]
    return blocks.select(
        "conv_id",
        (F.col("chunk") * size + first).alias("start"),
        upto(first).alias("prev"),
        F.when(full, F.when(closes, F.col("after")).otherwise(upto(first + WIDTH))).alias("after"),
        ((F.col("chunk") == F.col("last_chunk")) & (F.size("turns") <= first + WIDTH)).alias("last"),
        *[F.when(s.isNotNull(), F.struct(s["turn_id"].alias("id"), s["n_bytes"].alias("n_bytes"))).alias(f"t{i + 1}") for i, s in enumerate(slots)],
    )


def _name(turns: int) -> Column:
    """Name of the prefix that ends with turn ``turns`` of a block."""
    if turns == 0:
        return F.col("prev")
    if turns == WIDTH:
        return F.col("after")
    return _digest(F.col("prev"), *[F.col(f"t{i}.id") for i in range(1, turns + 1)])


def _rolled(blocks: DataFrame, measures: str) -> DataFrame:
    """All prefixes of all blocks at once: ``depth``, the block's columns and ``measures`` per prefix.

    ``grouping_id`` tells how many turns a row's prefix has; a prefix that ends before
    that turn, so that the turn is null, is no prefix of that length.
    """
    turns = [f"t{i}" for i in range(1, WIDTH + 1)]
    # The last turn brings the name of the whole block, so it counts twice where it is rolled up.
    rolled = blocks.sparkSession.sql(
        f"""select start, prev, {", ".join(turns)}, after, {measures},
                   if(grouping_id() = 0, {WIDTH}, {WIDTH + 1} - bit_count(grouping_id())) as own
            from {{blocks}} group by start, prev, rollup({", ".join(turns[:-1])}, ({turns[-1]}, after))""",
        blocks=blocks,
    )
    real = F.col("own") > 0
    for i, t in enumerate(turns, 1):
        real = real & ((F.col("own") != i) | F.col(t).isNotNull())
    return rolled.filter(real)


def _at(values: dict[int, Column]) -> Column:
    out = None
    for own, value in values.items():
        out = F.when(F.col("own") == own, value) if out is None else out.when(F.col("own") == own, value)
    return out


def _ends(blocks: DataFrame, convs: DataFrame) -> DataFrame:
    """``name`` and ``ends_sha256`` of every prefix that is a whole conversation.

    Ids of one prefix are joined to pieces of at most 4,096 in parallel; pieces in
    order then stream through one hash, which holds no more than a batch of them.
    """
    own = sum(F.col(f"t{i}").isNotNull().cast("int") for i in range(1, WIDTH + 1)).alias("own")
    whole = blocks.filter("last").select("*", own).select("conv_id", _at({i: _name(i) for i in range(1, WIDTH + 1)}).alias("name"))
    none = convs.join(blocks.filter("last").select("conv_id"), "conv_id", "left_anti").select("conv_id", F.lit(ROOT).alias("name"))
    ids = F.array_join(F.transform(F.sort_array(F.collect_list("conv_id")), lambda c: c.cast("string")), ",")
    pieces = whole.unionByName(none).groupBy("name", F.floor(F.col("conv_id") / PIECE).alias("piece")).agg(ids.alias("ids"))

    def run(batches):
        now, digest = None, None
        for batch in batches:
            names, digests = [], []
            for name, ids in zip(batch.column("name").to_pylist(), batch.column("ids").to_pylist()):
                if name != now:
                    if now is not None:
                        names.append(now)
                        digests.append(digest.hexdigest())
                    now, digest = name, hashlib.sha256(ids.encode())
                else:
                    digest.update(b"," + ids.encode())
            yield pa.RecordBatch.from_pydict({"name": names, "ends_sha256": digests}, schema=kept)
        if now is not None:
            yield pa.RecordBatch.from_pydict({"name": [now], "ends_sha256": [digest.hexdigest()]}, schema=kept)

    kept = pa.schema([("name", pa.string()), ("ends_sha256", pa.string())])
    schema = T.StructType([T.StructField("name", T.StringType()), T.StructField("ends_sha256", T.StringType())])
    return pieces.repartition("name").sortWithinPartitions("name", "piece").select("name", "ids").mapInArrow(run, schema)


def _suffix_values(nodes: DataFrame, blocks: DataFrame) -> DataFrame:
    """``conv_id``, ``start`` and ``s1`` .. ``s8``: what a conversation adds to the subtree of each prefix of its block.

    A node's own value belongs to its smallest member, which passes every node above
    it. So a prefix of a conversation gets the values that belong to it at this
    depth and below: sums from the far end, over chunks of 512 depths and their totals.
    """
    size = WIDTH * CHUNK
    value = (F.col("n_convs") - 1) * F.col("n_bytes")
    owned = nodes.select("conv_id", ((F.col("depth") - 1) - (F.col("depth") - 1) % WIDTH).alias("start"), F.floor((F.col("depth") - 1) / size).alias("chunk"), ((F.col("depth") - 1) % WIDTH).alias("slot"), value.alias("value"))
    slots = owned.groupBy("conv_id", "chunk", "start").agg(*[F.sum(F.when(F.col("slot") >= i, F.col("value"))).alias(f"s{i + 1}") for i in range(WIDTH)])
    # A block without values of its conversation still passes on what follows it.
    all_blocks = blocks.select("conv_id", F.floor(F.col("start") / size).alias("chunk"), "start")
    rows = all_blocks.join(slots, ["conv_id", "chunk", "start"], "left")
    chunks = rows.groupBy("conv_id", "chunk").agg(F.sum("s1").alias("total"))
    later = chunks.select("conv_id", "chunk", F.sum("total").over(Window.partitionBy("conv_id").orderBy("chunk").rowsBetween(1, Window.unboundedFollowing)).alias("later"))
    inside = Window.partitionBy("conv_id", "chunk").orderBy("start").rowsBetween(1, Window.unboundedFollowing)
    rows = rows.withColumn("rest", F.sum("s1").over(inside)).join(later.filter("later > 0"), ["conv_id", "chunk"], "left")
    beyond = F.coalesce("rest", F.lit(0)) + F.coalesce("later", F.lit(0))
    return rows.select("conv_id", "start", *[(F.coalesce(f"s{i + 1}", F.lit(0)) + beyond).alias(f"s{i + 1}") for i in range(WIDTH)])


def prefix_tree(placed: DataFrame, convs: DataFrame) -> DataFrame:
    """A row for each distinct sequence of first turns of any conversation, the root (no turns) included.

    ``placed`` has ``conv_id``, ``place`` (0, 1, ... without gaps), ``turn_id`` and ``n_bytes``;
    ``convs`` the ids of all conversations, turnless ones too. Returns
    ``conv_id`` (the smallest member, which with ``depth`` names the node), ``depth``,
    ``parent_conv_id`` (null at the root), ``n_convs`` (members), ``n_children``, ``n_leaves``
    (childless nodes of its subtree), ``saved_tokens`` (over its subtree, bytes of a
    node's last text for each member but one) and ``ends_sha256`` (of the ascending
    ids, joined by commas, of members that end there).

    One ROLLUP over the columns of a block counts all its prefixes; a long
    conversation goes on in further blocks, grouped by the name of the
    prefix before them, all blocks at once. Partial sums come before the shuffle, so a
    turn that every conversation begins with costs a row per task. A second ROLLUP
    adds up subtrees: leaves and saved bytes count at the smallest member of their node.
    Without conversations there is no node, not even a root.
    """
    blocks = stored(turn_blocks(placed), "turn_blocks")
    convs = stored(convs.distinct(), "conversations")
    counted = _rolled(blocks, "min(conv_id) as conv_id, count(*) as n_convs")
    names = {i: _name(i) for i in range(1, WIDTH + 1)}
    parents = {i: _name(i - 1) for i in range(1, WIDTH + 1)}
    bytes_of = {i: F.col(f"t{i}.n_bytes") for i in range(1, WIDTH + 1)}
    # A full block's name is known to members that have it; prefixes that end there all do.
    nodes = counted.select(
        _at(names).alias("name"), _at(parents).alias("parent"), (F.col("start") + F.col("own")).cast("long").alias("depth"), "conv_id", "n_convs", _at(bytes_of).alias("n_bytes")
    )
    root = convs.agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs")).filter("n_convs > 0")
    root = root.select(F.lit(ROOT).alias("name"), F.lit(None).cast("string").alias("parent"), F.lit(0).cast("long").alias("depth"), "conv_id", "n_convs", F.lit(0).cast("long").alias("n_bytes"))
    nodes = stored(nodes.unionByName(root), "trie_nodes")
    children = nodes.filter("parent is not null").groupBy(F.col("parent").alias("name")).agg(F.count("*").alias("n_children"))
    nodes = stored(nodes.join(children, "name", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0))), "trie_counts")

    leaves = nodes.filter("n_children = 0").select("conv_id", F.lit(1).alias("leaf"))
    values = _suffix_values(nodes.filter("depth > 0"), blocks)
    carried = blocks.join(values, ["conv_id", "start"], "left").join(leaves, "conv_id", "left")
    carried = stored(carried.withColumn("leaf", F.coalesce("leaf", F.lit(0))), "trie_blocks")
    sums = ", ".join(f"sum(s{i}) as s{i}" for i in range(1, WIDTH + 1))
    below = _rolled(carried, f"sum(leaf) as n_leaves, {sums}").select(_at(names).alias("name"), "n_leaves", _at({i: F.col(f"s{i}") for i in range(1, WIDTH + 1)}).alias("saved_tokens"))
    top = nodes.filter("depth > 0").agg(F.sum((F.col("n_convs") - 1) * F.col("n_bytes")).alias("saved_tokens"))
    all_leaves = nodes.filter("n_children = 0").agg(F.count("*").alias("n_leaves"))
    below = below.unionByName(root.select("name", all_leaves.scalar().alias("n_leaves"), F.coalesce(top.scalar(), F.lit(0)).alias("saved_tokens")))

    # The root has a child for every first turn; its id is one value and needs no join.
    above = nodes.filter("depth > 0").select(F.col("name").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    own_key = F.when(F.col("depth") > 1, F.col("parent")).otherwise(F.concat(F.lit("-"), F.col("name")))
    top_id = F.when(F.col("depth") == 1, root.select("conv_id").scalar())
    return (
        nodes.withColumn("parent", own_key).join(above, "parent", "left")
        .withColumn("parent_conv_id", F.coalesce("parent_conv_id", top_id))
        .join(below, "name", "left")
        .join(_ends(blocks, convs), "name", "left")
        .select(
            "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", F.col("n_leaves").cast("long").alias("n_leaves"),
            F.col("saved_tokens").cast("long").alias("saved_tokens"), F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
        )
    )
