"""Approximate nearest neighbours: a graph by NN-descent, queries by greedy search in it."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from streamgauge.llm.common import binary_rows, stored, text_bytes

#: Neighbours of a node; rounds of descent; neighbours that a node learns of in one neighbourhood.
DEGREE, ROUNDS, LEARNED = 32, 4, 5
#: First neighbours come from blocks of rows that lie side by side in the order of some sign codes.
CODES, BITS, BLOCK = 4, 11, 128
#: Candidates that a search keeps, and how many of them it visits in a step.
BEAM, VISITED = 512, 256
#: Queries whose search state one task holds.
TOGETHER = 64


def usable(vectors: DataFrame, id_column: str = "vec_id", column: str = "embedding") -> DataFrame:
    """``id`` and ``v`` (doubles) of vectors that can be compared.

    Null vectors, zero vectors and those with null, infinite or NaN components take
    no part, nor do rows without id. Of rows with one id the smallest vector
    counts; of several lengths the most frequent one does, of equal ones the
    smaller.
    """
    v = F.col(column).cast("array<double>")
    good = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    rows = vectors.select(F.col(id_column).alias("id"), v.alias("v")).filter(F.col("id").isNotNull() & F.coalesce(good, F.lit(False)))
    rows = rows.groupBy("id").agg(F.min("v").alias("v"))
    size = rows.groupBy(F.size("v").alias("n")).agg(F.count("*").alias("rows")).orderBy(F.desc("rows"), "n").limit(1)
    return rows.join(size.select("n"), F.size("v") == F.col("n"), "left_semi")


def _matrix(column: pa.Array) -> np.ndarray:
    """Rows of equally long float32 vectors kept as bytes."""
    data, borders = text_bytes(column)
    return data.view(np.float32).reshape(len(borders) - 1, -1) if len(data) else np.zeros((len(borders) - 1, 0), np.float32)


def _packed(rows: DataFrame) -> DataFrame:
    def run(batches):
        for batch in batches:
            flat = batch.column("v").flatten().to_numpy().astype(np.float32)
            yield pa.RecordBatch.from_arrays([batch.column("id"), binary_rows(flat, batch.column("v").offsets.to_numpy().astype(np.int64) - batch.column("v").offsets[0].as_py())], ["id", "x"])

    return rows.select("id", "v").mapInArrow(run, "id long, x binary")


_PAIR = "id long, other long, d float"


def _pairs_inside(groups: list[tuple[np.ndarray, np.ndarray, np.ndarray]], most: int):
    """For each member of each group its ``most`` nearest others there that beat its bound."""
    ids, others, ds = [], [], []
    for who, x, bound in groups:
        square = (x * x).sum(axis=1)
        d = np.maximum(square[:, None] + square[None] - 2 * x @ x.T, 0)
        d[who[:, None] == who[None]] = np.inf
        k = min(most, len(who) - 1)
        if k < 1:
            continue
        pick = np.argpartition(d, k - 1, axis=1)[:, :k]
        near = np.take_along_axis(d, pick, 1)
        use = near < bound[:, None]
        ids.append(np.repeat(who, k)[use.ravel()])
        others.append(who[pick.ravel()][use.ravel()])
        ds.append(near.ravel()[use.ravel()])
    if not ids:
        return pa.RecordBatch.from_arrays([pa.array([], pa.int64()), pa.array([], pa.int64()), pa.array([], pa.float32())], ["id", "other", "d"])
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate(ids)), pa.array(np.concatenate(others)), pa.array(np.concatenate(ds).astype(np.float32))], ["id", "other", "d"])


def _first_pairs(packed: DataFrame) -> DataFrame:
    """Near pairs from blocks of rows in the order of sign codes, a few orders in all.

    Blocks have a fixed size whatever the vectors, so equal or very close ones fill
    several blocks.
    """

    def code(batches):
        for batch in batches:
            if batch.num_rows == 0:
                continue
            x = _matrix(batch.column("x"))
            for k in range(CODES):
                planes = np.random.default_rng(1000 + k).normal(size=(x.shape[1], BITS + 1)).astype(np.float32)
                side = x @ planes
                codes = ((side[:, :BITS] > 0) << np.arange(BITS)).sum(axis=1)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(batch.num_rows, k, np.int32)), pa.array(codes.astype(np.int32)), pa.array(side[:, BITS]), batch.column("id"), batch.column("x")], ["k", "code", "place", "id", "x"])

    def block(batches):
        held = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            held = table if held is None else pa.concat_tables([held, table])
            whole = held.num_rows - held.num_rows % BLOCK
            if whole:
                yield inside(held.slice(0, whole))
                held = held.slice(whole)
        if held is not None and held.num_rows > 1:
            yield inside(held)

    def inside(rows):
        k, who, x = rows.column("k").to_numpy(), rows.column("id").to_numpy(), _matrix(rows.column("x"))
        groups = []
        for a in range(0, len(who), BLOCK):
            for kind in np.unique(k[a : a + BLOCK]):
                own = a + np.flatnonzero(k[a : a + BLOCK] == kind)
                groups.append((who[own], x[own], np.full(len(own), np.inf, np.float32)))
        return _pairs_inside(groups, 2 * LEARNED)

    dealt = packed.mapInArrow(code, "k int, code int, place float, id long, x binary").repartitionByRange("k", "code", "place", "id").sortWithinPartitions("k", "code", "place", "id")
    return dealt.mapInArrow(block, _PAIR)


def _nearest(pairs: DataFrame, degree: int) -> DataFrame:
    """The ``degree`` nearest different others of each id, with their ``rank`` from 0."""

    def run(batches):
        held = None
        for batch in batches:
            cols = [batch.column(c).to_numpy() for c in ("id", "other", "d")]
            if held is not None:
                cols = [np.concatenate(c) for c in zip(held, cols)]
            if len(cols[0]) == 0:
                continue
            cut = int(np.searchsorted(cols[0], cols[0][-1]))
            # Of the open id only its nearest rows so far can count.
            rest = [c[cut:] for c in cols]
            if len(rest[0]) > 8 * degree:
                rest = best(*rest)[:3]
            held = rest
            if cut:
                yield out(*best(*[c[:cut] for c in cols]))
        if held is not None and len(held[0]):
            yield out(*best(*held))

    def best(who, other, d):
        by = np.lexsort((other, d, who))
        who, other, d = who[by], other[by], d[by]
        new = np.ones(len(who), bool)
        new[1:] = (who[1:] != who[:-1]) | (other[1:] != other[:-1])
        who, other, d = who[new], other[new], d[new]
        start = np.flatnonzero(np.concatenate([[True], who[1:] != who[:-1]]))
        rank = np.arange(len(who)) - np.repeat(start, np.diff(np.concatenate([start, [len(who)]])))
        use = rank < degree
        return who[use], other[use], d[use], rank[use]

    def out(who, other, d, rank):
        return pa.RecordBatch.from_arrays([pa.array(who), pa.array(other), pa.array(d), pa.array(rank.astype(np.int32))], ["id", "other", "d", "rank"])

    return pairs.repartition("id").sortWithinPartitions("id").mapInArrow(run, _PAIR + ", rank int")


def _descended(edges: DataFrame, packed: DataFrame, degree: int) -> DataFrame:
    """One round: neighbours, and nearest ones to have a node as neighbour, meet at that node and learn of each other."""

    def run(batches):
        held = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            held = table if held is None else pa.concat_tables([held, table])
            if held.num_rows == 0:
                continue
            at = held.column("at").to_numpy()
            cut = int(np.searchsorted(at, at[-1]))
            if cut:
                yield meet(held.slice(0, cut))
            held = held.slice(cut)
        if held is not None and held.num_rows:
            yield meet(held)

    def meet(rows):
        at, who, x, bound = rows.column("at").to_numpy(), rows.column("id").to_numpy(), _matrix(rows.column("x")), rows.column("bound").to_numpy()
        edge = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1], [True]]))
        groups = []
        for a, b in zip(edge[:-1], edge[1:]):
            own, first = np.unique(who[a:b], return_index=True)
            groups.append((own, x[a:b][first], bound[a:b][first]))
        return _pairs_inside(groups, LEARNED)

    bounds = edges.groupBy("id").agg(F.max(F.when(F.col("rank") == degree - 1, F.col("d"))).alias("bound"))
    known = packed.join(bounds, "id", "left").select("id", "x", F.coalesce("bound", F.lit(float("inf"))).cast("float").alias("bound"))
    back = _nearest(edges.select(F.col("other").alias("id"), F.col("id").alias("other"), "d"), degree)
    met = edges.select(F.col("id").alias("at"), F.col("other").alias("id")).union(back.select(F.col("id").alias("at"), F.col("other").alias("id")))
    pairs = met.join(known, "id").select("at", "id", "x", "bound").repartition("at").sortWithinPartitions("at").mapInArrow(run, _PAIR)
    return _nearest(edges.select("id", "other", "d").union(pairs), degree)


def build_graph(packed: DataFrame, degree: int = DEGREE, rounds: int = ROUNDS) -> DataFrame:
    """Edges ``id``, ``other``, ``d`` (squared distance), ``rank`` to about the nearest others of every vector."""
    edges = stored(_nearest(_first_pairs(packed), degree), "graph")
    for _ in range(rounds):
        edges = stored(_descended(edges, packed, degree), "graph")
    return edges


_STATE = "query long, x binary, ids array<long>, ds array<float>, seen array<boolean>"


def search_graph(queries: DataFrame, packed: DataFrame, edges: DataFrame, entries: DataFrame, beam: int = BEAM, visited: int = VISITED) -> DataFrame:
    """The ``beam`` nearest ids found for each query: ``query``, ``id``, ``d`` (squared, in single precision).

    ``queries`` has ``query`` and its vector ``x``, ``entries`` has ``query`` and the
    ``id`` where its search begins. In every step each query visits its nearest
    candidates not yet visited, reads their neighbours with their vectors in a
    join, and keeps the best of all; it ends when all kept ones are visited. The
    state is small, so its number of tasks follows the number of queries.
    """
    tasks = queries.count() // TOGETHER + 1
    near = edges.select(F.col("id").alias("node"), F.col("other").alias("id")).join(packed, "id").groupBy("node").agg(F.collect_list(F.struct("id", "x")).alias("near"))
    near = stored(near, "graph_near")

    def start(batches):
        for batch in batches:
            x, y = _matrix(batch.column("x")), _matrix(batch.column("y"))
            d = ((x - y) ** 2).sum(axis=1).astype(np.float32) if batch.num_rows else np.zeros(0, np.float32)
            yield pa.RecordBatch.from_arrays([batch.column("query"), batch.column("x"), batch.column("id"), pa.array(d)], ["query", "x", "id", "d"])

    begun = entries.join(queries, "query").join(packed.select("id", F.col("x").alias("y")), "id").select("query", "x", "id", "y").mapInArrow(start, "query long, x binary, id long, d float").filter("id <> query")
    state = begun.groupBy("query").agg(F.first("x").alias("x"), F.collect_list(F.struct("id", "d")).alias("c"))
    state = stored(state.select("query", "x", F.col("c.id").alias("ids"), F.col("c.d").alias("ds"), F.transform("c", lambda _: F.lit(False)).alias("seen")), "search")

    def visit(batches):
        for batch in batches:
            if batch.num_rows == 0:
                continue
            lists = batch.column("near")
            count = np.diff(lists.offsets.to_numpy())
            flat = lists.flatten()
            y = _matrix(flat.field("x"))
            row = np.repeat(np.arange(batch.num_rows), count)
            query = batch.column("query").to_numpy()
            d = ((_matrix(batch.column("x"))[row] - y) ** 2).sum(axis=1)
            use = (d < batch.column("bound").to_numpy()[row]) & (flat.field("id").to_numpy() != query[row])
            yield pa.RecordBatch.from_arrays([pa.array(query[row[use]]), pa.array(flat.field("id").to_numpy()[use]), pa.array(d[use].astype(np.float32))], ["query", "id", "d"])

    def keep(batches):
        for batch in batches:
            out = {"ids": [], "ds": [], "seen": []}
            for old_ids, old_ds, old_seen, new in zip(*(batch.column(c) for c in ("ids", "ds", "seen", "new"))):
                ids, ds, seen = (np.array(v.values) for v in (old_ids, old_ds, old_seen))
                # What was visited before this step or in it: its first open candidates.
                open_at = np.flatnonzero(~seen)[:visited]
                seen = seen.copy()
                seen[open_at] = True
                if new.is_valid and len(new.values):
                    ids = np.concatenate([ids, np.array(new.values.field("id"))])
                    ds = np.concatenate([ds, np.array(new.values.field("d"))])
                    seen = np.concatenate([seen, np.zeros(len(ids) - len(seen), bool)])
                # Visited ones first among equals, so that they are not visited again.
                by = np.lexsort((~seen, ids))
                by = by[np.concatenate([[True], ids[by][1:] != ids[by][:-1]])]
                by = by[np.lexsort((ids[by], ds[by]))][:beam]
                for name, v in (("ids", ids), ("ds", ds), ("seen", seen)):
                    out[name].append(v[by])
            yield pa.RecordBatch.from_arrays(
                [batch.column("query"), batch.column("x"), pa.array(out["ids"], pa.list_(pa.int64())), pa.array(out["ds"], pa.list_(pa.float32())), pa.array(out["seen"], pa.list_(pa.bool_()))], ["query", "x", "ids", "ds", "seen"]
            )

    while True:
        todo = F.slice(F.filter(F.transform(F.arrays_zip("ids", "seen"), lambda e: F.when(~e["seen"], e["ids"])), lambda i: i.isNotNull()), 1, visited)
        bound = F.when(F.size("ds") >= beam, F.element_at("ds", beam)).otherwise(F.lit(float("inf"))).cast("float")
        steps = state.select("query", "x", bound.alias("bound"), F.explode(todo).alias("node"))
        if steps.isEmpty():
            break
        found = steps.join(near, "node").select("query", "x", "bound", "near").coalesce(4 * tasks).mapInArrow(visit, "query long, id long, d float").distinct()
        found = found.groupBy("query").agg(F.collect_list(F.struct("id", "d")).alias("new"))
        state = stored(state.join(found, "query", "left").select("query", "x", "ids", "ds", "seen", "new").coalesce(tasks).mapInArrow(keep, _STATE), "search")
    return state.select("query", F.inline(F.arrays_zip("ids", "ds"))).select("query", F.col("ids").alias("id"), F.col("ds").alias("d"))


def nearest_neighbours(vectors: DataFrame, query_condition, k: int = 10, id_column: str = "vec_id", column: str = "embedding") -> DataFrame:
    """The ``k`` nearest other vectors of every vector that meets ``query_condition`` (on ``id``), by Euclidean distance.

    Returns ``query_id``, ``rank`` (from 1), ``vec_id`` and ``score`` (the distance, in
    double precision on the original vectors), nearest first, ties to smaller ids.

    Equal vectors are one node, under their smallest id, and at the end each vector
    found, and the query's own, comes back as its ``k + 1`` smallest ids, so ties among
    equal vectors are exact. A graph of near nodes is built by descent: neighbours of a node, and
    nodes that have it as a neighbour, meet at the node in a join and learn of each
    other, so neighbours of neighbours become neighbours. A query starts at its
    own neighbours and at a few rows spread over the table. Vectors that can't be
    compared take no part (see ``usable``); with fewer than ``k`` others all are
    returned, and a table with fewer than ``BEAM`` rows is searched whole; other
    columns are ignored; an empty table gives an empty table.
    """
    rows = stored(usable(vectors, id_column, column), "vectors")
    place = F.row_number().over(Window.partitionBy("v").orderBy("id"))
    first = rows.withColumn("place", place).filter(F.col("place") <= k + 1)
    members = stored(first.select("id", F.min("id").over(Window.partitionBy("v")).alias("rep")), "vector_members")
    reps = stored(rows.join(members.filter("id = rep").select("id"), "id"), "vector_reps")
    packed = stored(_packed(reps), "vectors_packed")
    edges = build_graph(packed)
    asked = stored(rows.filter(query_condition).select(F.col("id").alias("query_id"), "v").join(reps.select(F.col("id").alias("rep"), "v"), "v").select("query_id", "rep"), "vector_queries")
    queries = packed.join(asked.select(F.col("rep").alias("id")).distinct(), "id").select(F.col("id").alias("query"), "x")
    spread = packed.orderBy(F.xxhash64("id"), "id").limit(BEAM).select("id")
    begin = edges.join(queries.select(F.col("query").alias("id")), "id", "left_semi").select(F.col("id").alias("query"), F.col("other").alias("id"))
    fixed = stored(spread, "entries")
    begin = begin.union(queries.select("query", F.explode(F.lit([r["id"] for r in fixed.collect()]).cast("array<long>")).alias("id"))).distinct()  # at most BEAM ids
    found = search_graph(queries, packed, edges, begin)

    def rank(batches):
        for batch in batches:
            a, b = batch.column("v").flatten().to_numpy(), batch.column("w").flatten().to_numpy()
            width = len(a) // max(batch.num_rows, 1)
            d = np.sqrt(((a - b).reshape(batch.num_rows, width) ** 2).sum(axis=1)) if batch.num_rows else np.zeros(0)
            yield pa.RecordBatch.from_arrays([batch.column("query"), batch.column("id"), pa.array(d)], ["query", "id", "score"])

    exact = found.join(reps, "id").join(reps.select(F.col("id").alias("query"), F.col("v").alias("w")), "query").select("query", "id", "v", "w").mapInArrow(rank, "query long, id long, score double")
    # The k nearest other vectors and the query's own hold the k nearest rows: each comes with its smallest ids.
    near = exact.withColumn("place", F.row_number().over(Window.partitionBy("query").orderBy("score", "id"))).filter(F.col("place") <= k).select("query", "id", "score")
    near = near.union(queries.select("query", F.col("query").alias("id"), F.lit(0.0).alias("score")))
    near = near.select(F.col("query").alias("rep"), F.col("id").alias("other"), "score")
    copies = members.select(F.col("rep").alias("other"), F.col("id").alias("vec_id"))
    every = asked.join(near, "rep").join(copies, "other").filter("vec_id <> query_id").select("query_id", "vec_id", "score")
    ranked = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return every.withColumn("rank", ranked).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
