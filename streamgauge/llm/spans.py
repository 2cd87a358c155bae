"""Removal of byte strings that stand earlier already, by suffix arrays over shards."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from streamgauge.llm.common import Rolling, binary_rows, give_back, slices, stored, text_bytes
from streamgauge.llm.induced import permuted_prefixes, suffix_array

#: Bytes of a seed: the smallest hash among the seeds of a window decides where the window is compared.
SEED = 32
#: Runs of one seed that meet in one task to find equal ones; more meet in parts first.
TOGETHER = 4096
#: Different runs of one seed that one suffix array takes, up to 5 MB; seeds with more are compared window by window.
FREQUENT = 32768

#: What becomes of a run of windows: it stands earlier too; its bytes are compared; its windows are, one by one.
REPEATED, COMPARED, FREQUENT_SEED = 0, 1, 2
#: Further, the first of its content in one part of a seed's runs.
IN_PART = 3


def _window_runs(known: Rolling, borders: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of window starts that share their deciding seed: the seed's hash, first start, number of starts.

    Equal windows have equal deciding seeds at equal offsets, the last smallest one
    in each, so what is equal anywhere meets under one hash.
    """
    none = np.zeros(0, np.int64)
    whole = int(borders[-1])
    n = whole - length + 1
    if n <= 0:
        return none.astype(np.uint64), none, none
    at = np.arange(whole - SEED + 1)
    hashes = known.of(at, at + SEED)
    low = np.uint64((1 << max(whole.bit_length(), 1)) - 1)
    packed = (hashes & ~low) | (low - at.astype(np.uint64))
    width = length - SEED + 1
    padded = np.full(-(-len(packed) // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[: len(packed)] = packed
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    least = np.minimum(behind[:n], ahead[width - 1 : width - 1 + n])
    seed = (low - (least & low)).astype(np.int64)
    inside = np.zeros(n, bool)
    sizes = np.diff(borders)
    long_rows = np.flatnonzero(sizes >= length)
    change = np.zeros(n + 1, np.int32)
    np.add.at(change, borders[long_rows], 1)
    np.add.at(change, borders[long_rows + 1] - length + 1, -1)
    inside = np.cumsum(change[:n]) > 0
    new = inside.copy()
    new[1:] &= (seed[1:] != seed[:-1]) | ~inside[:-1]
    first = np.zeros(n + 1, bool)
    first[borders[long_rows]] = True
    new |= first[:n] & inside
    begin = np.flatnonzero(new)
    ends = inside.copy()
    ends[:-1] &= new[1:] | ~inside[1:]
    return hashes[seed[begin]], begin, np.flatnonzero(ends) + 1 - begin


def _seeds(docs: DataFrame, length: int) -> DataFrame:
    """All runs of windows: seed ``h``, digest ``d`` of the bytes that the run covers, ``doc_id``, ``start``, ``run``."""

    def run(batches):
        for batch in slices(batches, "text"):
            data, borders = text_bytes(batch.column("text"))
            known = Rolling(data)
            h, begin, count = _window_runs(known, borders, length)
            row = np.searchsorted(borders, begin, "right") - 1
            d = known.of(begin, begin + count + length - 1)
            yield pa.RecordBatch.from_arrays(
                [pa.array(h.view(np.int64)), pa.array(d.view(np.int64)), batch.column("doc_id").take(pa.array(row)), pa.array((begin - borders[row]).astype(np.int32)), pa.array(count.astype(np.int32))],
                ["h", "d", "doc_id", "start", "run"],
            )

    return docs.filter("doc_id is not null").select("doc_id", "text").mapInArrow(run, "h long, d long, doc_id long, start int, run int")


def _in_groups(batches, column: str):
    """The sorted rows in tables that never part equal values of ``column``."""
    held = None
    for batch in batches:
        new = pa.Table.from_batches([batch])
        held = new if held is None else pa.concat_tables([held, new])
        if held.num_rows:
            key = held.column(column).to_numpy()
            cut = int(np.searchsorted(key, key[-1]))
            if cut:
                yield held.slice(0, cut)
            held = held.slice(cut)
    if held is not None and held.num_rows:
        yield held


_RUN = "h long, d long, doc_id long, start int, run int, kind int"


def _equal_runs(rows: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """For rows sorted by seed and digest: which are the first of their content, which stand later than it."""
    h, d, doc, start = (rows.column(c).to_numpy() for c in ("h", "d", "doc_id", "start"))
    new = np.concatenate([[True], (h[1:] != h[:-1]) | (d[1:] != d[:-1])])
    first = np.maximum.accumulate(np.where(new, np.arange(len(h)), 0))
    # A repeated row of the table is the same place, not a later one.
    return new, (doc != doc[first]) | (start != start[first])


def _with_kind(rows: pa.Table, kind: np.ndarray, keep: np.ndarray):
    out = rows.select(["h", "d", "doc_id", "start", "run"]).append_column("kind", pa.array(kind.astype(np.int32)))
    return out.filter(pa.array(keep)).to_batches()


def _sorted_out(runs: DataFrame) -> DataFrame:
    """Each run's ``kind``; runs that no other can equal, even in part, are left out.

    Runs of a seed with equal digests are equal: all but the first are repeated.
    The first ones are compared with each other unless there is just one. Runs of a
    seed with very many are dealt in parts, and the first ones of each part meet
    once more.
    """

    def once(batches):
        for rows in _in_groups(batches, "h"):
            h, parted = rows.column("h").to_numpy(), rows.column("n").to_numpy() > TOGETHER
            new, later = _equal_runs(rows)
            seeds = np.cumsum(np.concatenate([[True], h[1:] != h[:-1]])) - 1
            several = np.bincount(seeds, new)[seeds] > 1
            yield from _with_kind(rows, np.where(later, REPEATED, np.where(parted, IN_PART, COMPARED)), later | (new & (several | parted)))

    def again(batches):
        for rows in _in_groups(batches, "d"):
            new, later = _equal_runs(rows)
            yield from _with_kind(rows, np.where(later, REPEATED, COMPARED), later | new)

    part = F.when(F.col("n") > TOGETHER, F.pmod(F.xxhash64("doc_id", "start"), F.ceil(F.col("n") / TOGETHER))).otherwise(F.lit(0))
    dealt = runs.withColumn("part", part).repartition("h", "part").sortWithinPartitions("h", "d", "doc_id", "start")
    met = stored(dealt.select("h", "d", "n", "doc_id", "start", "run").mapInArrow(once, _RUN), "span_runs")
    dealt = met.filter(F.col("kind") == IN_PART).repartition("d").sortWithinPartitions("d", "h", "doc_id", "start")
    parted = stored(dealt.mapInArrow(again, _RUN), "span_parted")
    counts = parted.filter(F.col("kind") == COMPARED).groupBy("h").agg(F.count("*").alias("m"))
    kind = F.when(F.col("kind") == REPEATED, F.lit(REPEATED)).when(F.col("m") > FREQUENT, F.lit(FREQUENT_SEED)).otherwise(F.lit(COMPARED))
    sorted_out = parted.join(counts, "h", "left").filter((F.col("kind") == REPEATED) | (F.col("m") > 1)).withColumn("kind", kind).drop("m")
    return met.filter(F.col("kind") != IN_PART).unionByName(stored(sorted_out, "span_sorted"))


def _bytes_around(rows: DataFrame, length: int) -> DataFrame:
    """The bytes that compared runs cover; for frequent seeds, the digest ``d`` of each window."""

    def run(batches):
        for batch in slices(batches, "text", 1 << 19):
            data, borders = text_bytes(batch.column("text"))
            lists = {c: batch.column(c) for c in ("h", "start", "run", "kind")}
            counts = np.diff(lists["h"].offsets.to_numpy())
            h, start, size, kind = (lists[c].flatten().to_numpy() for c in lists)
            row = np.repeat(np.arange(batch.num_rows), counts)
            known = Rolling(data)
            ids = batch.column("doc_id").to_numpy()
            for frequent in (False, True):
                use = np.flatnonzero(kind == (FREQUENT_SEED if frequent else COMPARED))
                times = size[use] if frequent else np.ones(len(use), np.int64)
                source = np.repeat(use, times)
                begin = start[source] + np.arange(len(source)) - np.repeat(np.cumsum(times) - times, times)
                at = borders[row[source]] + begin
                took = np.full(len(source), length, np.int64) if frequent else size[source] + length - 1
                d = known.of(at, at + took).view(np.int64)
                for k in range(0, len(source), 20_000):
                    part = slice(k, k + 20_000)
                    own = source[part]
                    if frequent:
                        content = pa.nulls(len(own), pa.binary())
                    else:
                        edges = np.concatenate([[0], np.cumsum(took[part])])
                        content = binary_rows(data[np.repeat(at[part] - edges[:-1], took[part]) + np.arange(edges[-1])], edges)
                    runs = np.ones(len(own), np.int32) if frequent else size[own].astype(np.int32)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(h[own]), pa.array(d[part]), pa.array(ids[row[own]]), pa.array(begin[part].astype(np.int32)), pa.array(runs), content], ["h", "d", "doc_id", "start", "run", "context"]
                    )

    return rows.mapInArrow(run, "h long, d long, doc_id long, start int, run int, context binary")


def _repeated_windows(windows: DataFrame) -> DataFrame:
    """Windows of frequent seeds that stand earlier: ``doc_id``, ``start``, ``run``.

    The first place of each digest is a minimum, summed up in parts before the
    shuffle, and a join marks all others; a digest with very many places is split
    there like any skewed key.
    """
    least = windows.groupBy("h", "d").agg(F.min("doc_id").alias("first_doc"))
    placed = windows.join(least, ["h", "d"])
    inside = placed.filter("doc_id = first_doc").groupBy("h", "d").agg(F.min("start").alias("first_start"))
    return placed.join(inside, ["h", "d"]).filter("doc_id <> first_doc or start <> first_start").select("doc_id", "start", F.lit(1).alias("run"))


def _repeats_in_shards(contexts: DataFrame, length: int) -> DataFrame:
    """Runs of windows that stand earlier in another context of their shard: ``doc_id``, ``start``, ``run``.

    A shard is one Arrow batch of contexts, filled up to the end of its last seed:
    equal windows have equal seeds, so they share a shard.
    """
    def run(batches):
        for rows in _in_groups(batches, "h"):
            yield repeats(rows)
            give_back()

    def repeats(rows):
        doc, start, size = (rows.column(c).to_numpy().astype(np.int64) for c in ("doc_id", "start", "run"))
        data, borders = text_bytes(rows.column("context"))
        row = np.repeat(np.arange(rows.num_rows), size)
        inner = np.arange(len(row)) - np.repeat(np.cumsum(size) - size, size)
        at = borders[row] + inner
        order = suffix_array(data)
        place = np.empty(len(data), np.int64)
        place[order] = np.arange(len(data))
        order = np.argsort(place[at])
        common = permuted_prefixes(Rolling(np.concatenate([data, np.zeros(128, np.uint8)])), at, order, letters=data, least=length)
        new = common[order] < length
        new[0] = True
        who, where = doc[row], start[row] + inner
        by = np.lexsort((where, who))
        own = np.concatenate([[True], (who[by][1:] != who[by][:-1]) | (where[by][1:] != where[by][:-1])])
        rank = np.empty(len(row), np.int64)
        rank[by] = np.cumsum(own) - 1
        least = np.minimum.reduceat(rank[order], np.flatnonzero(new))[np.cumsum(new) - 1]
        later = np.unique(rank[order][rank[order] != least])
        who, where = who[by[own]][later], where[by[own]][later]
        joined = np.flatnonzero(np.concatenate([[True], (who[1:] != who[:-1]) | (where[1:] != where[:-1] + 1)])) if len(who) else np.zeros(0, np.int64)
        return pa.RecordBatch.from_arrays(
            [pa.array(who[joined]), pa.array(where[joined].astype(np.int32)), pa.array(np.diff(np.concatenate([joined, [len(who)]])).astype(np.int32))], ["doc_id", "start", "run"]
        )

    dealt = contexts.select("h", "doc_id", "start", "run", "context")
    return dealt.repartition("h").sortWithinPartitions("h").mapInArrow(run, "doc_id long, start int, run int")


def remove_repeats(docs: DataFrame, length: int = 100, carried: tuple[str, ...] = (), whole_characters: bool = False) -> DataFrame:
    """Remove every byte covered by a string of ``length`` bytes that also starts earlier.

    Earlier is a smaller doc_id, or a smaller start in the same document; strings
    never cross documents and are judged on the input. Returns ``doc_id``,
    ``n_bytes``, ``n_removed``, ``n_spans`` (maximal removed runs), ``kept`` (the
    remaining bytes) and the columns ``carried``, a row per row of ``docs``. With
    ``whole_characters`` a UTF-8 character that would lose some bytes loses all.

    Each window of ``length`` bytes is dealt by its deciding seed, and only runs
    of windows whose seed stands at several places go on. Of runs that cover equal
    bytes all but the first are repeated. The different ones of a seed go, with
    their bytes, to shards of bounded size; each builds a suffix array by induced
    sorting and common prefixes in text order, and windows with a common prefix of
    ``length`` are equal. Windows of a seed that is frequent among all documents
    are dealt one by one instead, by their own digest, so that a passage that a
    third of all documents hold is spread over tasks. Nothing is left out in
    either way.

    Null and empty texts have no bytes and no removals. Rows without doc_id are
    neither changed nor compared. Repeated rows with one doc_id are one place; their
    texts lose the same ranges. An empty table gives an empty table; other columns
    are ignored. Equality of contexts and windows rests on 64-bit hashes below
    equal 64-bit seeds.
    """
    counted = stored(_seeds(docs, length).groupBy("h").agg(F.count("*").alias("n")).filter("n > 1"), "span_seeds")
    runs = _sorted_out(_seeds(docs, length).join(counted.hint("shuffle_hash"), "h"))
    places = runs.filter(F.col("kind") != REPEATED).groupBy(F.col("doc_id").alias("id")).agg(F.collect_list(F.struct("h", "start", "run", "kind")).alias("p"))
    rows = docs.select("doc_id", "text").join(places, F.col("doc_id") == F.col("id")).select("doc_id", "text", *[F.col(f"p.{c}").alias(c) for c in ("h", "start", "run", "kind")])
    around = stored(_bytes_around(rows, length), "span_bytes")
    marks = (
        runs.filter(F.col("kind") == REPEATED).select("doc_id", "start", "run")
        .union(_repeated_windows(around.filter("context is null").select("h", "d", "doc_id", "start")))
        .union(_repeats_in_shards(around.filter("context is not null"), length))
    )
    marks = stored(marks.groupBy(F.col("doc_id").alias("id")).agg(F.collect_list(F.struct("start", "run")).alias("marks")), "span_marks")

    def cut(batches):
        for batch in slices(batches, "text"):
            data, borders = text_bytes(batch.column("text"))
            lists = batch.column("marks").fill_null(pa.scalar([], batch.column("marks").type))
            counts = lists.value_lengths().to_numpy()
            pairs = lists.flatten()
            row = np.repeat(np.arange(batch.num_rows), counts)
            begin = borders[row] + pairs.field("start").to_numpy()
            stop = np.minimum(begin + pairs.field("run").to_numpy() + length - 1, borders[row + 1])
            change = np.zeros(len(data) + 1, np.int64)
            np.add.at(change, np.minimum(begin, stop), 1)
            np.add.at(change, stop, -1)
            gone = np.cumsum(change[:-1]) > 0
            if whole_characters and len(data):
                first_byte = (data & 0xC0) != 0x80
                first_byte[borders[:-1][np.diff(borders) > 0]] = True
                gone = np.logical_or.reduceat(gone, np.flatnonzero(first_byte))[np.cumsum(first_byte) - 1]
            begins = gone.copy()
            first = np.zeros(len(data) + 1, bool)
            first[borders] = True
            begins[1:] &= ~gone[:-1] | first[1:-1]
            total = np.concatenate([[0], np.cumsum(gone)])
            spans = np.concatenate([[0], np.cumsum(begins)])
            kept = borders - total[borders]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(np.diff(borders)), pa.array(np.diff(total[borders])), pa.array(np.diff(spans[borders])), binary_rows(data[~gone], kept), *[batch.column(c) for c in carried]],
                ["doc_id", "n_bytes", "n_removed", "n_spans", "kept", *carried],
            )

    rows = docs.select("doc_id", "text", *carried)
    schema = T.StructType([rows.schema["doc_id"], *[T.StructField(c, T.LongType()) for c in ("n_bytes", "n_removed", "n_spans")], T.StructField("kept", T.BinaryType()), *[rows.schema[c] for c in carried]])
    return rows.join(marks, F.col("doc_id") == F.col("id"), "left").select("doc_id", "text", "marks", *carried).mapInArrow(cut, schema)
