"""Near-duplicates: b-bit MinHash signatures joined within a Hamming radius by several indexes."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from streamgauge.llm.common import Rolling, binary_rows, give_back, mixed, slices, stored, text_bytes, words_of
from streamgauge.llm.graph import components

#: A signature has SYMBOLS values of 8 bits, of which the first INDEXED are index keys. Texts whose sets
#: agree to 0.8 differ in 12.8 of those on average, with a deviation of 3.2, and in 51.2 of all, with a
#: deviation of 6.4: one in 100,000 such pairs differs in over RADIUS or in over WHOLE_RADIUS.
INDEXED, RADIUS = 64, 27
SYMBOLS, WHOLE_RADIUS = 256, 80
#: Rows of a bucket, or of a group of candidates, that are held against each other in one go, and bytes of their sets.
BLOCK, BLOCK_BYTES = 512, 4 << 20
#: Shared shingles that are counted in one go.
COLUMNS = 4096
#: Pairs that one task reduces to a spanning forest.
EDGES = 50_000
#: Most ids that are sent to all tasks, some 8 MB.
MOST_BROADCAST = 1 << 19

_FACTORS = mixed(np.arange(SYMBOLS, dtype=np.uint64), 21) | np.uint64(1)
_MASKS = mixed(np.arange(SYMBOLS, dtype=np.uint64), 22)


def shingles(data: np.ndarray, borders: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers and hashes of the distinct shingles of each row, in order of both."""
    starts, ends, row = words_of(data, borders)
    if len(starts) == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    word = Rolling(data, folded=True).of(starts, ends)
    count = np.bincount(row, minlength=len(borders) - 1)
    first = np.cumsum(count) - count
    rows, hashes = [], []
    with np.errstate(over="ignore"):
        for length in range(1, words + 1):
            if length < words:
                at = first[count == length]
            elif len(starts) >= words:
                at = np.flatnonzero(row[: len(row) - words + 1] == row[words - 1 :])
            else:
                continue
            joined = word[at]
            for j in range(1, length):
                joined = joined * np.uint64(0x9E3779B97F4A7C15) + word[at + j]
            rows.append(row[at])
            hashes.append(mixed(joined, length))
    rows, hashes = np.concatenate(rows), np.concatenate(hashes)
    order = np.lexsort((hashes, rows))
    rows, hashes = rows[order], hashes[order]
    new = np.ones(len(rows), bool)
    new[1:] = (rows[1:] != rows[:-1]) | (hashes[1:] != hashes[:-1])
    return rows[new], hashes[new]


def signatures(docs: DataFrame, words: int) -> DataFrame:
    """``doc_id``, ``n_shingles``, a 128-bit digest of the set (``d1``, ``d2``) and its signature ``sig``."""

    def run(batches):
        for batch in slices(batches, "text"):
            data, borders = text_bytes(batch.column("text"))
            rows, hashes = shingles(data, borders, words)
            n = np.bincount(rows, minlength=batch.num_rows)
            full = np.flatnonzero(n)
            begin = (np.cumsum(n) - n)[full]
            d1, d2 = np.zeros(batch.num_rows, np.uint64), np.zeros(batch.num_rows, np.uint64)
            sig = np.zeros((batch.num_rows, SYMBOLS), np.uint8)
            if len(full):
                with np.errstate(over="ignore"):
                    d1[full] = np.add.reduceat(mixed(hashes, 11), begin)
                    d2[full] = np.add.reduceat(mixed(hashes, 12), begin)
                    for k in range(SYMBOLS):
                        least = np.minimum.reduceat((hashes ^ _MASKS[k]) * _FACTORS[k], begin)
                        sig[full, k] = mixed(least, 23) >> np.uint64(56)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n.astype(np.int64)), pa.array(d1.view(np.int64)), pa.array(d2.view(np.int64)), binary_rows(sig.ravel(), np.arange(batch.num_rows + 1) * SYMBOLS)],
                ["doc_id", "n_shingles", "d1", "d2", "sig"],
            )
            give_back()

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n_shingles long, d1 long, d2 long, sig binary")


def _unpacked(column: pa.Array) -> np.ndarray:
    return text_bytes(column)[0].reshape(-1, SYMBOLS)


def chunk_keys(sig: np.ndarray, radius: int = RADIUS) -> np.ndarray:
    """Index keys of signatures, a column for each chunk and each symbol of it left out; the low bits name that symbol.

    ``radius // 2 + 1`` chunks: of two signatures within the radius, at least one
    chunk has at most one error, and leaving that symbol out gives equal keys.
    """
    edges = np.linspace(0, sig.shape[1], radius // 2 + 2).astype(int)
    wide = sig.astype(np.uint64)
    keys = []
    with np.errstate(over="ignore"):
        for chunk, (a, b) in enumerate(zip(edges[:-1], edges[1:])):
            for left_out in range(a, b):
                key = np.full(len(sig), chunk * 1000 + left_out, np.uint64)
                for i in range(a, b):
                    if i != left_out:
                        key = mixed(key, 31) + wide[:, i]
                keys.append(mixed(key, 32) & ~np.uint64(INDEXED - 1) | np.uint64(left_out))
    return np.stack(keys, axis=1)


def first_slot(a: np.ndarray, b: np.ndarray, radius: int = RADIUS) -> np.ndarray:
    """The first symbol that, left out, gives both signatures equal keys; a pair is compared in that bucket only."""
    edges = np.linspace(0, a.shape[1], radius // 2 + 2).astype(int)
    differs = a != b
    errors = np.add.reduceat(differs, edges[:-1], axis=1, dtype=np.int32)
    chunk = (errors <= 1).argmax(axis=1)
    own = differs & (np.repeat(np.arange(len(edges) - 1), np.diff(edges)) == chunk[:, None])
    return np.where(own.any(axis=1), own.argmax(axis=1), edges[chunk])


def _close(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether signatures lie within both radii."""
    out = (a[:, :INDEXED] != b[:, :INDEXED]).sum(axis=1) <= RADIUS
    some = np.flatnonzero(out)
    out[some] = (a[some] != b[some]).sum(axis=1) <= WHOLE_RADIUS
    return out


def _indexed(reps: DataFrame) -> DataFrame:
    def run(batches):
        for batch in batches:
            if batch.num_rows:
                keys = chunk_keys(_unpacked(batch.column("sig"))[:, :INDEXED])
                ids = np.repeat(batch.column("rep").to_numpy(), keys.shape[1])
                yield pa.RecordBatch.from_arrays([pa.array(keys.ravel().view(np.int64)), pa.array(ids)], ["key", "rep"])

    return reps.select("rep", "sig").mapInArrow(run, "key long, rep long")


def _within_radius(pairs: DataFrame, reps: DataFrame, percent: int) -> DataFrame:
    """Pairs whose signatures lie within the radius and whose set sizes allow a link."""

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                near = _close(_unpacked(batch.column("sig_a")), _unpacked(batch.column("sig_b")))
                yield pa.RecordBatch.from_arrays([batch.column("a").filter(pa.array(near)), batch.column("b").filter(pa.array(near))], ["a", "b"])

    x = reps.select(F.col("rep").alias("a"), F.col("sig").alias("sig_a"), F.col("n").alias("n_a"))
    y = reps.select(F.col("rep").alias("b"), F.col("sig").alias("sig_b"), F.col("n").alias("n_b"))
    fit = pairs.join(x, "a").join(y, "b").filter(100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b"))
    return fit.select("a", "b", "sig_a", "sig_b").mapInArrow(run, "a long, b long").distinct()


def _confirmed(pairs: DataFrame, docs: DataFrame, words: int, percent: int) -> DataFrame:
    """Those of ``pairs`` whose full sets share enough."""

    def compare(batches):
        for batch in batches:
            a, b = batch.column("set_a"), batch.column("set_b")
            linked = np.zeros(batch.num_rows, bool)
            for i in range(batch.num_rows):
                x, y = np.frombuffer(a[i].as_buffer(), np.uint64), np.frombuffer(b[i].as_buffer(), np.uint64)
                both = np.concatenate([x, y])
                both.sort()
                same = int((both[1:] == both[:-1]).sum())
                linked[i] = same > 0 and 100 * same >= percent * (len(both) - same)
            keep = pa.array(linked)
            yield pa.RecordBatch.from_arrays([batch.column("a").filter(keep), batch.column("b").filter(keep)], ["a", "b"])

    pairs = stored(pairs, "near_pairs")
    needed = pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct()
    full = _sets(docs, needed, words)
    x = full.select(F.col("doc_id").alias("a"), F.col("held").alias("set_a"))
    y = full.select(F.col("doc_id").alias("b"), F.col("held").alias("set_b"))
    return stored(pairs.join(x, "a").join(y, "b").mapInArrow(compare, "a long, b long").distinct(), "near_links")


def _forest(left: np.ndarray, right: np.ndarray, parent: list[int]) -> list[int]:
    """Which of the edges join two trees of ``parent``, which grows by them."""

    def top(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    kept = []
    for i, (a, b) in enumerate(zip(left.tolist(), right.tolist())):
        a, b = top(a), top(b)
        if a != b:
            parent[b] = a
            kept.append(i)
    return kept


def _reduced(pairs: DataFrame) -> DataFrame:
    """Fewer pairs that join the same rows: a spanning forest of every ``EDGES`` of them.

    Tiles of one large group find much the same rows under many keys; what they
    return shrinks to about the group's rows before components are sought.
    """

    def run(batches):
        place, parent = {}, []
        for batch in batches:
            a, b = batch.column("a"), batch.column("b")
            ends = []
            for column in (a, b):
                known = [place.setdefault(x, len(place)) for x in column.to_pylist()]
                ends.append(np.array(known, np.int64))
            parent.extend(range(len(parent), len(place)))
            kept = pa.array(_forest(*ends, parent), pa.int64())
            yield pa.RecordBatch.from_arrays([a.take(kept), b.take(kept)], ["a", "b"])

    pairs = stored(pairs, "near_across")
    return pairs.coalesce(max(1, -(-pairs.count() // EDGES))).mapInArrow(run, "a long, b long")


def _tiles(batches):
    """Whole tiles of rows that come sorted by tile, some at a time."""
    rest = None
    for batch in batches:
        rest = pa.Table.from_batches([batch]) if rest is None else pa.concat_tables([rest, pa.Table.from_batches([batch])])
        if rest.num_rows == 0:
            continue
        tile = rest.column("tile").to_numpy()
        other = np.flatnonzero(tile != tile[-1])
        whole = int(other[-1]) + 1 if len(other) else 0
        if whole:
            yield rest.slice(0, whole)
        rest = rest.slice(whole)
    if rest is not None and rest.num_rows:
        yield rest


def _cut(rows: DataFrame, key: str, blocks) -> DataFrame:
    """Rows of a key in every tile of theirs: one for each pair of the key's blocks, so a large key is spread over many tasks."""
    own = F.pmod(F.xxhash64("rep"), blocks).cast("int")
    each = rows.withColumn("blocks", blocks).withColumn("block", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    tile = F.xxhash64(key, F.least("block", "other"), F.greatest("block", "other"))
    return each.withColumn("tile", tile).withColumn("mixed", F.col("block") != F.col("other")).drop("blocks", "other")


def _across(members: DataFrame, percent: int = 0) -> DataFrame:
    """Pairs of one bucket within the radius that lie in different components, as far as they join rows of a tile.

    A tile compares all its pairs of signatures and returns a spanning forest of those
    within the radius, so never more pairs than rows. A bucket is cut into
    blocks of about ``BLOCK`` rows. Set sizes ``n`` rule out what they can.
    """

    def run(batches):
        for rows in _tiles(batches):
            tile, rep, component, block, cut, slot, n = (rows.column(c).to_numpy() for c in ("tile", "rep", "component", "block", "mixed", "slot", "n"))
            sig = _unpacked(rows.column("sig"))
            parent = list(range(len(tile)))
            start = np.flatnonzero(np.concatenate([[True], tile[1:] != tile[:-1]]))
            end = np.repeat(np.concatenate([start[1:], [len(tile)]]), np.diff(np.concatenate([start, [len(tile)]])))
            later = end - np.arange(len(tile)) - 1
            done, total = 0, np.concatenate([[0], np.cumsum(later)])
            while done < len(tile):
                stop = max(done + 1, int(np.searchsorted(total, total[done] + 50_000, "right")) - 1)
                times = later[done:stop]
                left = np.repeat(np.arange(done, stop), times)
                right = left + 1 + np.arange(len(left)) - np.repeat(np.cumsum(times) - times, times)
                fits = 100 * np.minimum(n[left], n[right]) >= percent * np.maximum(n[left], n[right])
                use = (component[left] != component[right]) & ((block[left] != block[right]) == cut[left]) & fits
                left, right = left[use], right[use]
                near = _close(sig[left], sig[right])
                left, right = left[near], right[near]
                near = first_slot(sig[left, :INDEXED], sig[right, :INDEXED]) == slot[left]
                left, right = left[near], right[near]
                kept = _forest(left, right, parent)
                yield pa.RecordBatch.from_arrays([pa.array(rep[left[kept]]), pa.array(rep[right[kept]])], ["a", "b"])
                done = stop

    tiled = _cut(members, "key", F.ceil(F.col("n_members") / BLOCK).cast("int"))
    tiled = tiled.select("tile", "rep", "component", "block", "mixed", F.col("key").bitwiseAND(INDEXED - 1).cast("int").alias("slot"), "n", "sig")
    return tiled.repartition("tile").sortWithinPartitions("tile").mapInArrow(run, "a long, b long")


def shared_sizes(sets: list[np.ndarray]) -> np.ndarray:
    """How many elements every two different sets share, by products of their rows of marks."""
    sizes = np.array([len(x) for x in sets])
    of = np.repeat(np.arange(len(sets)), sizes)
    _, column, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    order = np.argsort(column, kind="stable")
    several = count > 1
    order = order[several[column[order]]]
    place = (np.cumsum(several) - 1)[column[order]]
    out = np.zeros((len(sets), len(sets)))
    edges = np.searchsorted(place, np.arange(0, int(several.sum()) + COLUMNS, COLUMNS))
    for k, (a, b) in enumerate(zip(edges[:-1], edges[1:])):
        marks = np.zeros((len(sets), COLUMNS), np.float32)
        marks[of[order[a:b]], place[a:b] - k * COLUMNS] = 1
        out += marks @ marks.T
    return out.astype(np.int64)


def _linked(groups: DataFrame, percent: int) -> DataFrame:
    """Links of full sets between components of one group of candidates, as a spanning forest of each tile.

    ``groups`` has ``group``, ``rep``, ``component`` and the set ``held``. A group is
    cut into blocks of some hundred rows and a few MB of sets, and every pair of
    blocks is a tile: all its sets are compared exactly, and it returns fewer links than it has rows.
    """

    def run(batches):
        for some in _tiles(batches):
            tile = some.column("tile").to_numpy()
            edges = np.flatnonzero(np.concatenate([[True], tile[1:] != tile[:-1], [True]]))
            for a, b in zip(edges[:-1], edges[1:]):
                rows = some.slice(a, b - a)
                rep, component, block, cut = (rows.column(c).to_numpy() for c in ("rep", "component", "block", "mixed"))
                if b - a < 2 or (component == component[0]).all():
                    continue
                sets = [np.frombuffer(x.as_buffer(), np.uint64) for x in rows.column("held").combine_chunks()]
                n = np.array([len(x) for x in sets])
                same = shared_sizes(sets)
                linked = (same > 0) & (100 * same >= percent * (n[:, None] + n[None, :] - same))
                linked &= (component[:, None] != component[None, :]) & ((block[:, None] != block[None, :]) == cut[0])
                left, right = np.nonzero(np.triu(linked, 1))
                kept = _forest(left, right, list(range(len(rep))))
                yield pa.RecordBatch.from_arrays([pa.array(rep[left[kept]]), pa.array(rep[right[kept]])], ["a", "b"])

    sizes = groups.groupBy("group").agg(F.count("*").alias("rows"), F.sum(F.octet_length("held")).alias("bytes"))
    blocks = F.greatest(F.ceil(F.col("rows") / BLOCK), F.ceil(F.col("bytes") / BLOCK_BYTES)).cast("int")
    tiled = _cut(groups.join(sizes, "group"), "group", blocks).select("tile", "rep", "component", "block", "mixed", "held")
    return tiled.repartition("tile").sortWithinPartitions("tile").mapInArrow(run, "a long, b long")


def _sets(docs: DataFrame, ids: DataFrame, words: int) -> DataFrame:
    """``doc_id`` and the shingle hashes ``held`` of the documents named by ``ids`` (``id``)."""

    def run(batches):
        for batch in slices(batches, "text"):
            data, borders = text_bytes(batch.column("text"))
            rows, hashes = shingles(data, borders, words)
            edges = np.concatenate([[0], np.cumsum(np.bincount(rows, minlength=batch.num_rows))])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), binary_rows(hashes, edges)], ["doc_id", "held"])
            give_back()

    ids = stored(ids, "near_ids")
    ids = F.broadcast(ids) if ids.count() <= MOST_BROADCAST else ids
    return stored(docs.select("doc_id", "text").join(ids, F.col("doc_id") == F.col("id"), "left_semi").mapInArrow(run, "doc_id long, held binary"), "near_sets")


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """Groups of documents linked by sets of word shingles that agree to ``percent`` or more.

    Returns a row per document: ``doc_id``, ``n_shingles``, ``component_id`` (the
    smallest doc_id that links reach, its own included) and ``kept``.

    Documents with equal sets become one representative. Signatures of
    representatives are cut into chunks; each chunk, with each of its symbols left
    out in turn, is an index key, so every two signatures within the radius share
    a key. First each bucket is held against one row only, the one that shares most
    keys, and what full sets confirm is joined to components: a bucket of a thousand
    copies needs a thousand comparisons. Then only buckets that still hold several
    components are compared pair by pair, in tiles, and just across components: pairs of
    signatures within the radius give groups of candidates, and inside a group full sets are
    compared tile by tile. A tile never returns more pairs than it has rows, so no link that
    could join two components is left out, and pairs of a group never become rows.

    Words are lower-cased (A-Z only). A text with fewer words than a shingle is
    one shingle; null, empty and wordless texts have none and link with nothing.
    Rows without doc_id stay alone and are kept, with null as component. Rows that
    share a doc_id are one document: a link of one holds for all. An empty
    table gives an empty table; other columns are ignored.
    """
    sigs = stored(signatures(docs, words), "near_signatures")
    some = sigs.filter("n_shingles > 0 and doc_id is not null")
    classes = stored(some.groupBy("d1", "d2").agg(F.min("doc_id").alias("rep"), F.first("sig").alias("sig"), F.first("n_shingles").alias("n")), "near_classes")
    reps = classes.select("rep", "sig", "n")
    keys = _indexed(reps)
    counts = keys.groupBy("key").agg(F.count("*").alias("n_members")).filter("n_members > 1")
    buckets = stored(keys.join(counts, "key"), "near_buckets")

    # The row that shares most keys with others is closest to most of its bucket.
    shares = buckets.groupBy("rep").agg(F.sum("n_members").alias("weight"))
    hubs = buckets.join(shares, "rep").groupBy("key").agg(F.max_by("rep", "weight").alias("hub"))
    stars = buckets.join(hubs, "key").filter("rep <> hub").select(F.greatest("rep", "hub").alias("a"), F.least("rep", "hub").alias("b")).distinct()
    stars = stored(_within_radius(stars, reps, percent), "near_stars")
    links = _confirmed(stars, docs, words, percent)
    found = stored(components(links), "near_components")

    def placed(now):
        return stored(buckets.join(now, F.col("rep") == F.col("node"), "left").select("key", "rep", "n_members", F.coalesce("component", "rep").alias("component")), "near_placed")

    # What is left: pairs across components. Signatures group the rows that may be linked, full sets link them.
    rows = placed(found)
    several = rows.groupBy("key").agg((F.min("component") != F.max("component")).alias("several")).filter("several").select("key")
    open_rows = stored(rows.join(several, "key"), "near_open")
    candidates = components(_reduced(_across(open_rows.join(reps, "rep").select("key", "rep", "n_members", "component", "sig", "n"), percent)))
    groups = stored(candidates.select(F.col("node").alias("rep"), F.col("component").alias("group")), "near_groups")
    sets = _sets(docs, groups.select(F.col("rep").alias("id")), words).dropDuplicates(["doc_id"])
    own = groups.join(found, F.col("rep") == F.col("node"), "left").select("group", "rep", F.coalesce("component", "rep").alias("component"))
    more = _reduced(_linked(own.join(sets, F.col("rep") == F.col("doc_id")).select("group", "rep", "component", "held"), percent))
    joined = components(found.select(F.col("node").alias("a"), F.col("component").alias("b")).union(more))

    return (
        sigs.select("doc_id", "n_shingles", "d1", "d2")
        .join(classes.select("d1", "d2", "rep"), ["d1", "d2"], "left")
        .join(joined, F.col("rep") == F.col("node"), "left")
        .withColumn("component_id", F.when(F.col("doc_id").isNotNull(), F.coalesce(F.when(F.col("n_shingles") > 0, F.coalesce("component", "rep")), "doc_id")))
        .select("doc_id", "n_shingles", "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"))
    )
