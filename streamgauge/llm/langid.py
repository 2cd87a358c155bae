"""Language of text and of its parts: script ranges, word scores, and a Viterbi path over words."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from streamgauge.llm.common import Rolling, give_back, slices, text_bytes, words_of

SLOTS = 1 << 16
#: Cost of a change of language between two words, in nats.
SWITCH = 8.0
#: A language is a candidate for a script that at least this share of its words is written in.
SCRIPT_SHARE = 0.01
FLOOR = 1e-7

# First bytes of UTF-8 sequences by script.
SCRIPT_RANGES = [
    ("latin", 0x41, 0x5A), ("latin", 0x61, 0x7A), ("latin", 0xC3, 0xCA), ("greek", 0xCD, 0xCF), ("cyrillic", 0xD0, 0xD4),
    ("hebrew", 0xD6, 0xD7), ("arabic", 0xD8, 0xDB), ("indic", 0xE0, 0xE0), ("southeast", 0xE1, 0xE1), ("kana", 0xE3, 0xE3),
    ("han", 0xE4, 0xE9), ("hangul", 0xEA, 0xED),
]
SCRIPTS = [""] + list(dict.fromkeys(name for name, _, _ in SCRIPT_RANGES))
_SCRIPT_OF = np.zeros(256, np.uint8)
for _name, _low, _high in SCRIPT_RANGES:
    _SCRIPT_OF[_low : _high + 1] = SCRIPTS.index(_name)

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


@dataclass
class LanguageModel:
    """``scores[feature]`` holds a row per slot and a column per language; the last slot is neutral."""

    langs: list[str]
    scores: list[np.ndarray]
    allowed: np.ndarray
    prior: np.ndarray


def _features(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Slots of 3- and 4-byte pieces of all words (with one space around each) and the words' borders in them."""
    size = ends - starts
    borders = np.concatenate([[0], np.cumsum(size + 2)])
    padded = np.full(borders[-1], 32, np.uint8)
    inside = np.ones(borders[-1], bool)
    inside[borders[:-1]] = False
    inside[borders[1:] - 1] = False
    covered = np.zeros(len(data) + 1, np.int8)
    covered[starts] += 1
    np.add.at(covered, ends, -1)
    padded[inside] = _LOWER[data[np.cumsum(covered[:-1]) > 0]]
    wide = np.concatenate([padded, np.zeros(3, np.uint8)]).astype(np.uint32)
    n = len(padded)
    three = wide[:n] | wide[1 : n + 1] << np.uint32(8) | wide[2 : n + 2] << np.uint32(16)
    four = three | wide[3 : n + 3] << np.uint32(24)
    out = []
    for value, length in ((three, 3), (four, 4)):
        slot = ((value * np.uint32(0x9E3779B1)) >> np.uint32(16)).astype(np.int32)
        for back in range(1, length):
            slot[borders[1:] - back] = SLOTS
        out.append(slot)
    return out, borders


def _word_slots(known: Rolling, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return (known.of(starts, ends) >> np.uint64(48)).astype(np.int32)


def _scripts(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The script of each word, 0 without letters; of several, the one later in the table."""
    if len(starts) == 0:
        return np.zeros(0, np.uint8)
    cuts = np.stack([starts, ends], axis=1).ravel()
    kinds = np.concatenate([_SCRIPT_OF[data], np.zeros(1, np.uint8)])
    return np.maximum.reduceat(kinds, cuts)[::2]


def fit_languages(docs: DataFrame, train) -> LanguageModel:
    """Learn from all rows with text and ``lang`` that meet the condition ``train``.

    Counts of pieces and words go into a fixed number of hashed slots for each
    language, summed over all rows, so the model's size does not grow with the
    corpus.
    """
    rows = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & train).select("lang", "text")
    langs = sorted(r[0] for r in rows.select("lang").distinct().collect())
    code = {lang: i for i, lang in enumerate(langs)}
    width = [SLOTS + 1, SLOTS + 1, SLOTS + 1, len(SCRIPTS)]

    def count(batches):
        total = [np.zeros((len(langs), w), np.int64) for w in width]
        for batch in slices(batches, "text"):
            data, borders = text_bytes(batch.column("text"))
            starts, ends, row = words_of(data, borders)
            if len(starts) == 0:
                continue
            lang = np.array([code[v] for v in batch.column("lang").to_pylist()])[row]
            pieces, at = _features(data, starts, ends)
            by_piece = np.repeat(lang, np.diff(at))
            whole = _word_slots(Rolling(data, folded=True), starts, ends)
            for i, (slot, of) in enumerate(((pieces[0], by_piece), (pieces[1], by_piece), (whole, lang), (_scripts(data, starts, ends), lang))):
                total[i] += np.bincount(of * width[i] + slot, minlength=total[i].size).reshape(total[i].shape)
        for i, table in enumerate(total):
            for lang in range(len(langs)):
                slot = np.flatnonzero(table[lang])
                if len(slot):
                    yield pa.RecordBatch.from_pydict({"feature": [i], "lang": [lang], "slots": [slot.astype(np.int32).tobytes()], "counts": [table[lang][slot].tobytes()]}, schema)

    schema = pa.schema([("feature", pa.int32()), ("lang", pa.int32()), ("slots", pa.binary()), ("counts", pa.binary())])

    summed_schema = pa.schema([f for f in schema if f.name != "slots"])

    def add(batches):
        key, sums = None, None
        for batch in batches:
            for feature, lang, slots, counts in zip(*(c.to_pylist() for c in batch.columns)):
                if (feature, lang) != key:
                    if key is not None:
                        yield table(key, sums)
                    key, sums = (feature, lang), np.zeros(width[feature], np.int64)
                sums[np.frombuffer(slots, np.int32)] += np.frombuffer(counts, np.int64)
        if key is not None:
            yield table(key, sums)

    def table(key, sums):
        return pa.RecordBatch.from_pydict({"feature": [key[0]], "lang": [key[1]], "counts": [sums.tobytes()]}, summed_schema)

    counted = rows.mapInArrow(count, "feature int, lang int, slots binary, counts binary")
    summed = counted.repartition("feature", "lang").sortWithinPartitions("feature", "lang").mapInArrow(add, "feature int, lang int, counts binary")
    totals = [np.zeros((w, len(langs))) for w in width]
    for r in summed.collect():  # one row for each feature and language
        totals[r["feature"]][:, r["lang"]] = np.frombuffer(r["counts"], np.int64)
    scores = []
    for t in totals[:3]:
        t[SLOTS] = 0
        share = t / np.maximum(t.sum(axis=0), 1) + FLOOR
        scores.append((np.log(share) - np.log(share.sum(axis=1, keepdims=True) / max(len(langs), 1))).astype(np.float32))
    script = totals[3]
    allowed = script >= SCRIPT_SHARE * np.maximum(script.sum(axis=0), 1)
    words = script.sum(axis=0)
    return LanguageModel(langs, scores, allowed, np.log((words + 1) / (words.sum() + max(len(langs), 1))) * 1e-6)


def word_scores(model: LanguageModel, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """How much each word speaks for each language; 0 everywhere for words without letters or of an unknown script."""
    out = np.zeros((len(starts), len(model.langs)), np.float32)
    if len(starts) == 0:
        return out
    pieces, at = _features(data, starts, ends)
    for table, slot in zip(model.scores[:2], pieces):
        out += np.add.reduceat(table[slot], at[:-1], axis=0)
    out += model.scores[2][_word_slots(Rolling(data, folded=True), starts, ends)]
    np.clip(out, -12, 12, out=out)
    script = _scripts(data, starts, ends)
    allowed = model.allowed[script]
    out[~allowed] = -24
    out[(script == 0) | ~allowed.any(axis=1)] = 0
    return out


def best_path(scores: np.ndarray, count: np.ndarray, switch: float = SWITCH) -> np.ndarray:
    """The language of each word on the best path of each document.

    ``scores`` has the words of all documents on end, ``count`` their numbers. A
    document stays in its best language throughout if no stretch, with the best
    other language taken for each of its words, gains more than the changes there
    and back cost: no mix of other languages gains more than that. Running sums rule
    such documents out; the others take the full recursion, all at once, word by word.
    """
    path = np.zeros(len(scores), np.int32)
    full = np.flatnonzero(count)
    if len(full) == 0 or scores.shape[1] < 2:
        return path
    first = np.cumsum(count) - count
    row = np.repeat(np.arange(len(full)), count[full])
    total = np.add.reduceat(scores.astype(np.float64), first[full], axis=0)
    top = total.argmax(axis=1)
    path[:] = top[row]
    words = np.arange(len(scores))
    others = scores.astype(np.float64)
    others[words, top[row]] = -np.inf
    gain = others.max(axis=1) - scores[words, top[row]]
    run = np.cumsum(gain)
    base = (run - gain)[first[full]]
    run -= base[row]
    high = 2 * (np.abs(run).max() + 1)
    before = np.concatenate([[0.0], run[:-1]])
    before[first[full]] = 0
    low = np.minimum.accumulate(before - high * row) + high * row
    last = first[full] + count[full] - 1
    inner = np.maximum.reduceat(run - low, first[full]) > 2 * switch
    from_start = np.maximum.reduceat(run, first[full]) > switch
    to_end = run[last] - low[last] > switch
    mixed = inner | from_start | to_end
    todo = full[mixed]
    if len(todo) == 0:
        return path
    todo = todo[np.argsort(-count[todo], kind="stable")]
    begin, size = first[todo], count[todo]
    stays = np.zeros(scores.shape, bool)
    lead = np.zeros(len(scores), np.int32)
    value = np.zeros((len(todo), scores.shape[1]))
    alive = np.searchsorted(-size, -np.arange(size[0]), "left")
    for t in range(size[0]):
        n = alive[t]
        at, now = begin[:n] + t, value[:n]
        lead[at] = now.argmax(axis=1)
        reach = now.max(axis=1, keepdims=True) - switch
        stays[at] = now >= reach
        np.maximum(now, reach, out=now)
        now += scores[at]
    state = value.argmax(axis=1)
    for t in range(size[0] - 1, -1, -1):
        n = alive[t]
        at, now = begin[:n] + t, state[:n]
        path[at] = now
        state[:n] = np.where(stays[at, now], now, lead[at])
    return path


def _labelled(batch: pa.RecordBatch, model: LanguageModel) -> tuple[pa.Array, pa.Array, pa.Array]:
    """Language, score and spans of each text."""
    data, borders = text_bytes(batch.column("text"))
    starts, ends, row = words_of(data, borders)
    n, langs = batch.num_rows, len(model.langs)
    scores = word_scores(model, data, starts, ends)
    count = np.bincount(row, minlength=n)
    path = best_path(scores, count)
    weight = np.where(np.abs(scores).sum(axis=1) > 0, ends - starts, 0) if langs else np.zeros(len(starts))
    share = np.zeros((n, max(langs, 1)))
    np.add.at(share, (row, path), weight)
    total = np.zeros((n, max(langs, 1)))
    if langs:
        for lang in range(langs):
            total[:, lang] = np.bincount(row, scores[:, lang], n)
        share += model.prior - model.prior.min() + 1e-9
    best = share.argmax(axis=1)
    of_all = share[np.arange(n), best] / np.maximum(share.sum(axis=1), 1e-12)
    behind = np.clip(total - total[np.arange(n), best][:, None], -50, 50)
    clear = 1 / np.exp(behind).sum(axis=1)
    letters = np.zeros(n, bool)
    plain = (data | 32) - 97 < 26
    if len(data):
        full = np.flatnonzero(np.diff(borders))
        letters[full] = np.logical_or.reduceat(plain, borders[full])
    texts = batch.column("text")
    for i in np.flatnonzero(~letters & (np.diff(borders) > 0)):
        letters[i] = any(c.isalpha() for c in texts[i].as_py())
    known = letters & (langs > 0)
    names = [model.langs[b] if k else "und" for b, k in zip(best, known)]
    change = np.ones(len(path), bool)
    change[1:] = (path[1:] != path[:-1]) | (row[1:] != row[:-1])
    change &= known[row]
    begin = np.flatnonzero(change)
    last = np.concatenate([begin[1:], [len(path)]]) - 1
    if len(begin):
        closes = np.ones(len(path), bool)
        closes[:-1] = (path[1:] != path[:-1]) | (row[1:] != row[:-1])
        last = np.flatnonzero(closes & known[row])
    own = borders[row[begin]]
    spans = pa.StructArray.from_arrays(
        [pa.array((starts[begin] - own).astype(np.int32)), pa.array((ends[last] - own).astype(np.int32) if len(begin) else np.zeros(0, np.int32)), pa.array([model.langs[p] for p in path[begin]], pa.string())],
        ["start", "end", "lang"],
    )
    edges = np.concatenate([[0], np.cumsum(np.bincount(row[begin], minlength=n))]).astype(np.int32)
    return pa.array(names, pa.string()), pa.array(np.where(known, np.clip(of_all * clear, 0, 1), 0.0)), pa.ListArray.from_arrays(pa.array(edges), spans)


def label_languages(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """``doc_id``, ``lang_pred``, ``score`` and ``spans`` of every whole text.

    ``spans`` lists stretches of one language as byte ranges with their language.
    ``lang_pred`` is the language of most bytes of scored words, of equal ones the
    first in order. ``score`` is that share of bytes times how clearly the whole
    text prefers the language. Null texts, texts without a letter, and a model
    without languages give ``und``, 0 and no spans; repeated rows are labelled
    each; other columns are ignored; an empty table gives an empty table.
    """

    def run(batches):
        for batch in slices(batches, "text"):
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *_labelled(batch, model)], ["doc_id", "lang_pred", "score", "spans"])
            give_back()

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, lang_pred string, score double, spans array<struct<start: int, end: int, lang: string>>")


def known_language(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """The rows of ``docs`` whose text has a language, all columns as they are; ``und`` goes, a null ``lang`` is filled in."""

    def run(batches):
        for batch in slices(batches, "text"):
            names = _labelled(batch, model)[0]
            lang = batch.schema.get_field_index("lang")
            columns = batch.columns
            columns[lang] = pc.coalesce(columns[lang], names)
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names).filter(pc.not_equal(names, "und"))
            give_back()

    return docs.mapInArrow(run, docs.schema)
