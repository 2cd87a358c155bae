"""Periodic runs of words: stretches in which a short sequence of words repeats, by online catching of squares."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from streamgauge.llm.common import mixed, slices, text_bytes, words_of

RUN = "array<struct<start:bigint,length:bigint,period:bigint>>"


def _stretches(hit: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last index of each unbroken stretch of ``hit`` within one ``group``."""
    opens, closes = hit.copy(), hit.copy()
    same = group[1:] == group[:-1]
    opens[1:] &= ~(hit[:-1] & same)
    closes[:-1] &= ~(hit[1:] & same)
    return np.flatnonzero(opens), np.flatnonzero(closes)


def _ranges(low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All whole numbers of the ranges ``low`` .. ``high`` - 1 on end, and the range that each belongs to."""
    sizes = np.maximum(high - low, 0)
    of = np.repeat(np.arange(len(low)), sizes)
    return np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes) + low[of], of


def _inside_known(runs: list[np.ndarray], low: np.ndarray, high: np.ndarray, period: np.ndarray) -> np.ndarray:
    """Whether a known run whose period divides ``period`` holds all of ``low`` .. ``high`` - 1.

    At most one known run can, as the ranges are longer than two smaller periods
    together; so it is the one that reaches farthest of those that start in time.
    """
    if not sum(r.shape[1] for r in runs):
        return np.zeros(len(low), bool)
    start, length, known = np.concatenate(runs, axis=1)
    order = np.argsort(start, kind="stable")
    start, end, known = start[order], (start + length)[order], known[order]
    farthest = np.maximum.accumulate(end)
    at = np.arange(len(end))
    best = np.maximum.accumulate(np.where(end == farthest, at, 0))
    place = np.searchsorted(start, low, "right") - 1
    chosen = best[np.maximum(place, 0)]
    return (place >= 0) & (farthest[np.maximum(place, 0)] >= high) & (period % known[chosen] == 0)


def word_runs(words: np.ndarray, counts: np.ndarray, least: int, times: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, length and period of the runs in rows of word numbers on end; starts count over all rows.

    Rows are appended word by word. At every level a completed block of 2^l words
    has a catcher, which looks for its block at the ends that later words reach,
    at distances 2^l to 2^(l+1) - 1. One appended word so advances one comparison
    of suffixes a level: window against block, by hashes that double in width with
    the level. Where two blocks in a row are caught at one distance, they and
    their copies are a square of that period. Squares in a row merge, and letter
    by letter comparison from one block before to one block after them gives the run.

    A run of period q and ``times`` (4 or more) repetitions covers two blocks and their
    copies at the level of q, wherever it starts, so none is missed; equal words
    have equal hashes, and letters decide. Multiples of a smaller period lie
    inside a run of a lower level and are left out. Runs come in no order.
    """
    if times < 4:
        raise ValueError("two blocks in a row need four repetitions")
    # Longest rows first: a level needs a prefix only. A word of its own ends each row.
    rows = np.argsort(-counts, kind="stable")
    begins = np.cumsum(counts) - counts
    size = counts[rows] + 1
    first = np.cumsum(size) - size
    at, of = _ranges(begins[rows], begins[rows] + size)
    ids = np.append(words, 0)[np.minimum(at, len(words))].astype(np.int64)
    ends = first + size - 1
    ids[ends] = -1 - np.arange(len(rows))
    window = mixed(ids.view(np.uint64), 3)
    known: list[np.ndarray] = []
    level = 0
    while True:
        width = 1 << level
        enough = int(np.searchsorted(-counts[rows], -times * width, "right"))
        if enough == 0:
            break
        n = int(ends[enough - 1]) + 1
        window = window[:n]
        blocks = -(-n // width)
        grid = np.zeros(blocks * width, np.uint64)
        grid[:n] = window
        grid = grid.reshape(blocks, width)
        caught = grid[1:] == grid[:-1, :1]
        square = caught[:-1] & caught[1:]
        block, extra = np.nonzero(square)
        if len(block):
            order = np.lexsort((block, extra))
            block, extra = block[order], extra[order]
            breaks = np.flatnonzero((extra[1:] != extra[:-1]) | (block[1:] != block[:-1] + 1)) + 1
            start, stop = block[np.append(0, breaks)], block[np.append(breaks - 1, len(block) - 1)]
            period = width + extra[np.append(0, breaks)]
            low, high = start * width, (stop + 2) * width
            row = np.searchsorted(first, low, "right") - 1
            new = (high + period <= ends[row]) & ~_inside_known(known, low, high + period, period)
            low, high, period, row = low[new], high[new], period[new], row[new]
            i, group = _ranges(np.maximum(low - width, first[row]), np.minimum(high + width, ends[row] - period))
            if len(i):
                a, b = _stretches(ids[i] == ids[i + period[group]], group)
                q = period[group[a]]
                length = i[b] - i[a] + 1 + q
                whole = length >= times * q
                known.append(np.array([i[a][whole], length[whole], q[whole]]))
        ahead = np.zeros(n, np.uint64)
        ahead[: n - width] = window[width:]
        with np.errstate(over="ignore"):
            window = window * np.uint64(0x9E3779B97F4A7C15) + ahead
            window ^= window >> np.uint64(29)
            window *= np.uint64(0xBF58476D1CE4E5B9)
            window ^= window >> np.uint64(32)
        level += 1
    if not known:
        none = np.zeros(0, np.int64)
        return none, none, none
    start, length, period = np.concatenate(known, axis=1)
    row = np.searchsorted(first, start, "right") - 1
    start = start - first[row] + begins[rows[row]]
    long = length >= least
    return start[long], length[long], period[long]


def find_runs(docs: DataFrame, least: int = 6, times: int = 4) -> DataFrame:
    """The periodic runs of every text, and the text without their repetitions.

    Words are separated by space, tab, line feed, vertical tab, form feed and
    carriage return, and numbered from 0. A run is a stretch of words with a smallest period q
    (words q apart are equal), at least ``least`` and ``times`` * q words long, that no
    neighbouring word extends. A word is dropped if any run holds it after that
    run's first q words. Returns ``doc_id``, ``n_words``, ``runs`` (an array of ``start``,
    ``length``, ``period``, by start, then period) and ``kept`` (the other words with one
    space between them), a row for each row of ``docs``.

    Rows are handled where they lie, without a shuffle; a task holds one row or
    some MB of rows, and its memory follows the longest text. Null and empty texts have
    no words and an empty ``kept``; rows that share a doc_id are texts of their own; a
    null doc_id stays; an empty table gives an empty table; other columns are ignored.
    """

    def run(batches):
        for batch in slices(batches, "text"):
            data, borders = text_bytes(batch.column("text"))
            starts, ends, row = words_of(data, borders)
            letters = data[~((data == 32) | ((data >= 9) & (data <= 13)))]
            offsets = np.append(0, np.cumsum(ends - starts)).astype(np.int32)
            words = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(letters.tobytes())])
            numbers = words.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
            counts = np.bincount(row, minlength=batch.num_rows)
            begins = np.append(0, np.cumsum(counts))
            start, length, period = word_runs(numbers, counts, least, times)
            dropped = np.zeros(len(numbers) + 1, np.int64)
            np.add.at(dropped, start + period, 1)
            np.add.at(dropped, start + length, -1)
            stays = np.cumsum(dropped[:-1]) == 0
            left = np.append(0, np.cumsum(np.bincount(row[stays], minlength=batch.num_rows)))
            kept = pc.binary_join(pa.ListArray.from_arrays(pa.array(left.astype(np.int32)), words.filter(pa.array(stays))), b" ")
            order = np.lexsort((period, start))
            start, length, period = start[order], length[order], period[order]
            of = row[start] if len(start) else start
            found = pa.StructArray.from_arrays([pa.array(start - begins[of]), pa.array(length), pa.array(period)], ["start", "length", "period"])
            upto = np.searchsorted(of, np.arange(batch.num_rows + 1)).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.ListArray.from_arrays(pa.array(upto), found), kept.cast(pa.string())], ["doc_id", "n_words", "runs", "kept"]
            )

    schema = T.StructType([T.StructField("doc_id", docs.schema["doc_id"].dataType), T.StructField("n_words", T.LongType()), T.StructField("runs", T.DataType.fromDDL(RUN)), T.StructField("kept", T.StringType())])
    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(run, schema)
