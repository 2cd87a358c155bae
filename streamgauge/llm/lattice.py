"""Log probability of text under a subword unigram model, over all segmentations at once."""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from streamgauge.llm.common import Rolling, slices, stored, text_bytes, words_of

#: Most words whose counts travel to all tasks; counts of the others are joined.
HEAD_WORDS = 1 << 18
#: Words in memory before a counting task writes them out.
FLUSH_WORDS = 1 << 18
#: Words of up to so many bytes go through the lattice side by side, longer ones one by one.
SIDE_BY_SIDE = 64
SMOOTHING = 0.1


def read_pieces(path: str) -> tuple[list[bytes], np.ndarray]:
    """Pieces and natural-log scores of a sentencepiece vocabulary; every single byte is a piece.

    A leading space stands for the start of a word. Where the file holds ranks
    instead of log probabilities, as merge vocabularies do, a piece's probability
    is taken as inverse to its rank. Pieces that lower-cased words cannot hold are
    left out.
    """
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    best: dict[bytes, float] = {}
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i).replace("▁", " ").encode()
        if model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or piece.lower() != piece or not piece or b" " in piece[1:]:
            continue
        best[piece] = max(model.get_score(i), best.get(piece, -math.inf))
    if best and min(best.values()) < -100:
        for rank, piece in enumerate(sorted(best, key=best.get, reverse=True)):
            best[piece] = -math.log(rank + 2)
    least = min(best.values(), default=0.0) - 5
    for byte in range(256):
        best.setdefault(bytes([byte]), least)
    scores = np.array(list(best.values()))
    return list(best), scores - np.logaddexp.reduce(scores)


class Pieces:
    """Finds pieces by the hash of their bytes."""

    def __init__(self, pieces: list[bytes]):
        data = np.frombuffer(b"".join(pieces), np.uint8)
        size = np.array([len(p) for p in pieces])
        end = np.cumsum(size)
        self.hashes = np.append(Rolling(data).of(end - size, end), np.uint64(0))
        self.lengths = sorted(set(size.tolist()))
        bits = 20
        while True:
            self.shift = np.uint64(64 - bits)
            self.mask = np.uint64((1 << bits) - 1)
            high, low = (self.hashes[:-1] >> self.shift).astype(np.int64), (self.hashes[:-1] & self.mask).astype(np.int64)
            self.first = np.full(1 << bits, len(pieces), np.int32)
            self.first[high] = np.arange(len(pieces))
            left = np.flatnonzero(self.first[high] != np.arange(len(pieces)))
            if len(np.unique(low[left])) == len(left):
                self.second = np.full(1 << bits, len(pieces), np.int32)
                self.second[low[left]] = left
                return
            bits += 1

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Numbers of the pieces, the number of pieces where there is none."""
        at = self.first[(hashes >> self.shift).astype(np.int64)]
        miss = np.flatnonzero(self.hashes[at] != hashes)
        other = self.second[(hashes[miss] & self.mask).astype(np.int64)]
        at[miss] = np.where(self.hashes[other] == hashes[miss], other, len(self.hashes) - 1)
        return at


def _log_sum(rows: np.ndarray) -> np.ndarray:
    top = rows.max(axis=0)
    with np.errstate(divide="ignore"):
        return top + np.log(np.exp(rows - np.where(np.isfinite(top), top, 0)).sum(axis=0))


def word_log_probs(words: list[bytes], pieces: Pieces, scores: np.ndarray, counts: np.ndarray | None = None, expected: np.ndarray | None = None) -> np.ndarray:
    """Natural log of each word's probability, summed over all its segmentations.

    ``scores`` has one for each piece and, last, that of a word's stop. Forward recursion over end positions in log space. With ``counts``, a backward
    pass adds the expected uses of each piece to ``expected``.
    """
    out = np.zeros(len(words))
    scores, stop = np.append(scores[:-1], -np.inf), scores[-1]
    size = np.array([len(w) + 1 for w in words], np.int64)
    buffer = np.frombuffer(b"".join([b" " + w for w in words]), np.uint8)
    begin = np.cumsum(size) - size
    known = Rolling(buffer)
    order = np.argsort(size, kind="stable")
    edges = np.flatnonzero(np.concatenate([[True], np.diff(size[order]) > 0, [True]])) if len(order) else []
    for a, b in zip(edges[:-1], edges[1:]):
        length = int(size[order[a]])
        step = max(1, (1 << 15)) if length <= SIDE_BY_SIDE else 1
        for k in range(a, b, step):
            own = order[k : min(k + step, b)]
            at = begin[own]
            steps = [n for n in pieces.lengths if n <= length]
            found = {n: pieces.find(known.of((at + np.arange(length - n + 1)[:, None]).ravel(), (at + n + np.arange(length - n + 1)[:, None]).ravel())).reshape(-1, len(own)) for n in steps}
            alpha = np.full((length + 1, len(own)), -np.inf)
            alpha[0] = 0
            for i in range(1, length + 1):
                alpha[i] = _log_sum(np.stack([alpha[i - n] + scores[found[n][i - n]] for n in steps if n <= i]))
            out[own] = alpha[length] + stop
            if counts is None:
                continue
            beta = np.full((length + 1, len(own)), -np.inf)
            beta[length] = 0
            for i in range(length - 1, -1, -1):
                beta[i] = _log_sum(np.stack([beta[i + n] + scores[found[n][i]] for n in steps if i + n <= length]))
            weight = counts[own]
            for n in steps:
                use = np.exp(alpha[: length - n + 1] + scores[found[n]] + beta[n:] - alpha[length]) * weight
                expected += np.bincount(found[n].ravel(), use.ravel(), len(scores))[:-1]
    return out


def count_words(docs: DataFrame) -> DataFrame:
    """``word`` (bytes) and its count ``c`` in all of ``docs``; words are lower-cased (A-Z only)."""

    def emit(counter):
        return pa.RecordBatch.from_arrays([pa.array(list(counter.keys()), pa.binary()), pa.array(list(counter.values()), pa.int64())], ["word", "c"])

    def run(batches):
        held: Counter = Counter()
        for batch in batches:
            for text in batch.column("text").cast(pa.binary()):
                if text.is_valid:
                    held.update(text.as_py().lower().split())
                    if len(held) > FLUSH_WORDS:
                        yield emit(held)
                        held = Counter()
        if held:
            yield emit(held)

    return docs.select("text").mapInArrow(run, "word binary, c long").groupBy("word").agg(F.sum("c").alias("c"))


def _weighted(pieces: list[bytes], uses: np.ndarray, stops: float) -> np.ndarray:
    """Log probabilities from uses: of the pieces that start a word, and of all others together with, last, the stop of a word."""
    starts = np.array([p[:1] == b" " for p in pieces])
    out = np.log(uses)
    out[starts] -= math.log(uses[starts].sum())
    inner = math.log(uses[~starts].sum() + stops)
    out[~starts] -= inner
    return np.append(out, math.log(stops) - inner)


def _learned(words: DataFrame, distinct: int, pieces: list[bytes], scores: np.ndarray, rounds: int) -> np.ndarray:
    """Piece and stop scores after ``rounds`` of expectation and maximisation over all distinct words.

    Each distinct word counts once: the lattice has to spell words not met before,
    and those are like rare words, not like frequent ones.
    """
    now = _weighted(pieces, np.exp(scores), 0.2)
    for _ in range(rounds):

        def expect(batches, now=now):
            lookup = Pieces(pieces)
            total = np.zeros(len(pieces))
            for batch in batches:
                word_log_probs(batch.column("word").to_pylist(), lookup, now, np.ones(batch.num_rows), total)
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_pydict({"piece": at, "n": total[at]})

        total = np.full(len(pieces), SMOOTHING)
        for r in words.mapInArrow(expect, "piece long, n double").groupBy("piece").agg(F.sum("n").alias("n")).collect():  # at most one row for each piece
            total[r["piece"]] += r["n"]
        now = _weighted(pieces, total, max(distinct, 1))
    return now


def score_texts(docs: DataFrame, train, vocabulary: str, rounds: int = 2) -> DataFrame:
    """Probability of every whole text under subword pieces learned from the documents that meet ``train``.

    The pieces come from the file ``vocabulary``; its scores start the weights, and
    ``rounds`` of expectation and maximisation fit them to all words of all
    training documents. A text's probability is the product over its
    words of the sum over all segmentations, and of the chance of an end. A word of
    the training documents has one more edge, over the whole word, with its
    discounted share of all tokens; what the discounts leave weighs the
    segmentations into pieces.

    Returns ``doc_id``, ``n_tokens``, ``n_known``, ``train_tokens``,
    ``base_score`` (add-one word unigrams, log10) and ``score`` (log10), a row per
    row of ``docs``. One end per text counts as a token. Counts of at most
    ``HEAD_WORDS`` frequent words travel to all tasks; those of all other words are
    joined, by a 64-bit hash of the word. Null and empty texts are one end;
    repeated rows are scored each; with no training documents every count is 0;
    an empty table gives an empty table; other columns are ignored.
    """
    spark = docs.sparkSession
    rows = docs.select("doc_id", "text", train.alias("trains"))
    words = stored(count_words(rows.filter("trains")), "lm_words")
    texts = rows.filter("trains").count()
    step = F.floor(F.log2("c") * 16).cast("int")
    levels = sorted(words.groupBy(step.alias("level")).agg(F.count("*").alias("n"), F.sum("c").alias("c")).collect(), reverse=True)  # under 1,100 levels
    distinct, tokens = sum(r["n"] for r in levels) + (texts > 0), sum(r["c"] for r in levels) + texts
    lowest, room = None, HEAD_WORDS
    for r in levels:
        room -= r["n"]
        if room < 0:
            break
        lowest = r["level"]
    pieces, start = read_pieces(vocabulary)
    scores = _learned(words, distinct, pieces, start, rounds if tokens > texts else 0)
    once, twice = (sum(r["n"] for r in levels if r["level"] == 16 * k) for k in (0, 1))
    discount = once / (once + 2 * twice) if once and twice else 0.5
    spelled = math.log10(discount * distinct / tokens) if tokens else 0.0
    frequent = words.filter(step >= lowest).toArrow() if lowest is not None else None
    head = frequent.column("word").to_pylist() if frequent is not None else []
    head_logs = spelled + word_log_probs(head, Pieces(pieces), scores) / math.log(10)
    size = np.array([len(w) for w in head], np.int64)
    stop = np.cumsum(size)
    keys = Rolling(np.frombuffer(b"".join(head), np.uint8)).of(stop - size, stop) if head else np.zeros(0, np.uint64)
    by = np.argsort(keys)
    keys, head_logs = np.append(keys[by], np.uint64(0xFFFFFFFFFFFFFFFF)), np.append(head_logs[by], 0.0)
    head_counts = np.append(frequent.column("c").to_numpy()[by], 0) if head else np.zeros(1, np.int64)
    head_logs = np.log10(np.maximum(head_counts - discount, 0) / max(tokens, 1) + 10.0**head_logs)
    shared = spark.sparkContext.broadcast((keys, head_logs, head_counts, scores))
    many = len(head)

    def run(batches):
        keys, head_logs, head_counts, scores = shared.value
        lookup = Pieces(pieces)
        for whole in batches:
            parts, rare = [], {}
            for batch in slices(iter([whole]), "text"):
                data, borders = text_bytes(batch.column("text"))
                starts, ends, row = words_of(data, borders)
                hashes = Rolling(data, folded=True).of(starts, ends)
                order = np.lexsort((hashes, row))
                h, r = hashes[order], row[order]
                first = np.flatnonzero(np.concatenate([[True], (h[1:] != h[:-1]) | (r[1:] != r[:-1])])) if len(h) else np.zeros(0, np.int64)
                n = np.diff(np.concatenate([first, [len(h)]]))
                h, r, source = h[first], r[first], order[first]
                at = np.searchsorted(keys[:-1], h)
                known = keys[at] == h if many else np.zeros(len(h), bool)
                tail = np.flatnonzero(~known)
                raw = data.tobytes()
                for v, s, e in zip(h[tail].tolist(), starts[source[tail]].tolist(), ends[source[tail]].tolist()):
                    if v not in rare:
                        rare[v] = raw[s:e].lower()
                parts.append((batch, len(borders) - 1, h, r, n, at, known, tail))
            rare_logs = spelled + word_log_probs(list(rare.values()), lookup, scores) / math.log(10)
            rare_keys = np.array(list(rare.keys()), np.uint64)
            by = np.argsort(rare_keys)
            rare_keys, rare_logs = rare_keys[by], rare_logs[by]
            for batch, rows_n, h, r, n, at, known, tail in parts:
                spelt = rare_logs[np.searchsorted(rare_keys, h[tail])] if len(tail) else np.zeros(0)
                total = lambda w: np.bincount(r, w, rows_n).astype(float)
                edges = np.concatenate([[0], np.cumsum(np.bincount(r[tail], minlength=rows_n))]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id"),
                        pa.array(total(n.astype(float)).astype(np.int64) + 1),
                        pa.array(total(n * known.astype(float)).astype(np.int64)),
                        pa.array(total(n * np.where(known, np.log10(head_counts[at] + 1.0), 0.0))),
                        pa.array(total(n * np.where(known, head_logs[at], 0.0))),
                        pa.ListArray.from_arrays(pa.array(edges), pa.StructArray.from_arrays([pa.array(h[tail].view(np.int64)), pa.array(n[tail].astype(np.int32)), pa.array(spelt)], ["h", "n", "spelt"])),
                    ],
                    ["doc_id", "n_tokens", "known", "logs", "score", "rare"],
                )

    done = docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n_tokens long, known long, logs double, score double, rare array<struct<h: long, n: int, spelt: double>>")
    done = stored(done.withColumn("row", F.monotonically_increasing_id()), "lm_scored")

    def hashed(batches):
        for batch in batches:
            column = batch.column("word")
            data, borders = text_bytes(column)
            yield pa.RecordBatch.from_arrays([pa.array(Rolling(data).of(borders[:-1], borders[1:]).view(np.int64)), batch.column("c")], ["h", "c"])

    others = words.filter(step < lowest) if lowest is not None else words
    whole = F.when(F.col("c").isNull(), F.col("spelt")).otherwise(F.log10((F.col("c") - discount) / float(max(tokens, 1)) + F.pow(F.lit(10.0), F.col("spelt"))))
    found = (
        done.select("row", F.inline("rare")).join(others.mapInArrow(hashed, "h long, c long").groupBy("h").agg(F.sum("c").alias("c")), "h", "left")
        .groupBy("row").agg(
            F.sum(F.when(F.col("c").isNotNull(), F.col("n"))).alias("more"), F.sum(F.col("n") * F.log10(F.col("c") + 1.0)).alias("more_logs"), F.sum(F.col("n") * whole).alias("more_score")
        )
    )
    end_known, end_log = int(texts > 0), math.log10(texts + 1)
    end_score = math.log10(max(texts - discount, 1e-12) / tokens) if texts else 0.0
    nothing = F.lit(0.0)
    return done.drop("rare").join(found, "row", "left").select(
        "doc_id", "n_tokens", (F.col("known") + F.coalesce("more", F.lit(0)) + end_known).alias("n_known"), F.lit(tokens).cast("long").alias("train_tokens"),
        (F.col("logs") + F.coalesce("more_logs", nothing) + F.lit(end_log) - F.col("n_tokens") * F.lit(math.log10(tokens + distinct + 1))).alias("base_score"),
        (F.col("score") + F.coalesce("more_score", nothing) + F.lit(end_score)).alias("score"),
    )
