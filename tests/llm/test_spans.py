import random

import numpy as np
import pytest
from helpers import docs_of
from hypothesis import given, settings
from hypothesis import strategies as st

from streamgauge.llm import induced, spans
from streamgauge.llm.common import Rolling


def brute(rows, length):
    """Kept bytes of each row, by a table of all strings met so far."""
    seen, out = {}, []
    order = sorted((r for r in rows if r[0] is not None), key=lambda r: r[0])
    for doc_id, text in order:
        data = (text or "").encode()
        gone = bytearray(len(data))
        for i in range(len(data) - length + 1):
            place = seen.setdefault(data[i : i + length], (doc_id, i))
            if place != (doc_id, i):
                gone[i : i + length] = b"\1" * length
        kept = bytes(c for c, g in zip(data, gone) if not g)
        out.append((doc_id, len(data), sum(gone), sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone)), kept))
    out += [(None, len((t or "").encode()), 0, 0, (t or "").encode()) for d, t in rows if d is None]
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(4)
    letters = "abcdé "
    passage = "".join(rng.choice(letters) for _ in range(260))
    line = "a very common line that stands in every document, again and again, of over a hundred bytes in all, yes.\n"
    out = [(i, "".join(rng.choice(letters) for _ in range(rng.randint(0, 300))) + (line if i % 2 else "") + passage[rng.randint(0, 90) :]) for i in range(40)]
    out += [(50, None), (51, ""), (52, "z" * 450), (53, line * 3), (54, out[3][1]), (3, out[3][1]), (None, out[4][1]), (55, passage[:100]), (56, passage[:99])]
    return out


@pytest.mark.parametrize(("together", "frequent"), [(4096, 4096), (3, 4096), (3, 3)])
def test_equals_brute_force(spark, rows, together, frequent, monkeypatch):
    monkeypatch.setattr(spans, "TOGETHER", together)
    monkeypatch.setattr(spans, "FREQUENT", frequent)
    got = spans.remove_repeats(docs_of(spark, rows), length=100).collect()
    assert sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in got), key=str) == brute(rows, 100)


def test_whole_characters_and_carried_columns(spark):
    passage = "é" + "".join(f"{i} " for i in range(100, 130)) + "ü"
    rows = [(1, "x" + passage), (2, "Ã" + passage[1:] + "Ł")]
    got = {r.doc_id: r for r in spans.remove_repeats(docs_of(spark, rows), carried=("source", "lang"), whole_characters=True).collect()}
    assert bytes(got[2].kept).decode() == "ÃŁ" and got[1].n_removed == 0


def test_empty(spark):
    assert spans.remove_repeats(docs_of(spark, [])).count() == 0
    assert [r.n_removed for r in spans.remove_repeats(docs_of(spark, [(1, None)])).collect()] == [0]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 3), min_size=1, max_size=80), st.booleans())
def test_suffix_array_sorts_suffixes(values, singly):
    text = bytes(values)
    before, induced.MOST_BUCKETS = induced.MOST_BUCKETS, 6 if singly else 10**6
    try:
        assert induced.suffix_array(np.frombuffer(text, np.uint8), 4).tolist() == sorted(range(len(text)), key=lambda i: text[i:])
    finally:
        induced.MOST_BUCKETS = before


def test_every_level_is_induced(monkeypatch):
    """Texts of 200 KB go through both kinds of induction and several levels."""
    dice = np.random.default_rng(5)
    words = [bytes(dice.integers(97, 123, dice.integers(2, 9)).astype(np.uint8)) for _ in range(3000)]
    text = np.frombuffer(b" ".join(words[i] for i in dice.zipf(1.3, 40_000) % 3000), np.uint8)
    seen, whole = [], induced._ordered
    monkeypatch.setattr(induced, "_ordered", lambda s, letters: seen.append((len(s), letters)) or whole(s, letters))
    order = induced.suffix_array(text)
    assert len(seen) >= 2 and seen[1][1] > induced.MOST_BUCKETS
    assert np.array_equal(np.sort(order), np.arange(len(text)))
    raw = text.tobytes()
    picks = dice.integers(1, len(order), 3000)
    assert all(raw[order[i - 1] : order[i - 1] + 5000] <= raw[order[i] : order[i] + 5000] for i in picks)


def test_names_follow_letters():
    s = np.array([2, 1, 3, 1, 3, 2, 1, 3, 1, 2, 0])
    small = induced._smaller_than_next(s)
    marks = np.flatnonzero(small[1:] & ~small[:-1]) + 1
    order = induced._induced_singly(s, small, marks, 4)
    ordered = order[np.isin(order, marks)]
    names = induced._names(s, marks, ordered)
    stop = np.minimum(np.append(marks[1:], marks[-1]) + 1, len(s))
    pieces = [tuple(s[a:b]) for a, b in zip(marks, stop)]
    assert all((names[i] == names[j]) == (pieces[i] == pieces[j]) for i in range(len(marks)) for j in range(len(marks)))


@pytest.mark.parametrize("read", [1, 50, 1 << 20])
def test_equal_stretches(monkeypatch, read):
    monkeypatch.setattr(induced, "READ", read)
    dice = np.random.default_rng(3)
    data = dice.integers(0, 2, 300)
    a = np.sort(dice.choice(280, 150, replace=False))
    b = dice.integers(0, 280, 150)
    b[1:][dice.random(149) < 0.6] = 0
    for k in range(1, 150):
        if a[k] == a[k - 1] + 1 and b[k] == 0:
            b[k] = min(b[k - 1] + 1, 280)
    want = [bool((data[x : x + 6] == data[y : y + 6]).all()) for x, y in zip(a, b)]
    assert induced.equal_stretches(data, a, b, 6).tolist() == want


def test_a_wrong_hash_is_found_out():
    class Blind:
        def of(self, a, b):
            return np.zeros(len(a), np.uint64)

    data = np.frombuffer(b"abcdefgh" * 4 + b"abcdxfgh" * 2, np.uint8)
    starts = np.arange(len(data) - 8)
    order = induced.suffix_array(data)
    order = order[order < len(starts)]
    got = induced.permuted_prefixes(Blind(), starts, np.searchsorted(starts, order), 15, data, 8)
    for x, y in zip(order[:-1], order[1:]):
        assert (got[y] >= 8) == (data[x : x + 8].tobytes() == data[y : y + 8].tobytes())


def test_permuted_prefixes():
    text = b"abracadabra abracadabra"
    starts = np.arange(len(text))
    order = induced.suffix_array(np.frombuffer(text, np.uint8))
    got = induced.permuted_prefixes(Rolling(np.concatenate([np.frombuffer(text, np.uint8), np.arange(200, 232, dtype=np.uint8)])), starts, order, 15)
    padded = text + bytes(range(200, 232))
    for a, b in zip(order[:-1], order[1:]):
        n = 0
        while n < 15 and padded[a + n] == padded[b + n]:
            n += 1
        assert got[b] == n


def test_suffix_array_of_some_thousand_letters():
    text = np.random.default_rng(5).integers(0, 2000, 4000)
    words = text.tolist()
    assert induced.suffix_array(text, 2000).tolist() == sorted(range(len(words)), key=lambda i: words[i:])
