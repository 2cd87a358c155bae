"""Suffix arrays by induced sorting, in whole-array steps where buckets are large."""

from __future__ import annotations

from array import array

import numpy as np

#: A level with more names than this is induced suffix by suffix: a step per bucket would cost more than the suffixes in it.
MOST_BUCKETS = 1024
#: Letters that are compared in one go; a longer stretch is read whole.
READ = 1 << 18


def _smaller_than_next(s: np.ndarray) -> np.ndarray:
    """For each suffix, whether it is smaller than the one after it; the last, an end mark, is."""
    n = len(s)
    turn = np.where(s[:-1] != s[1:], np.arange(n - 1), n)
    turn = np.minimum.accumulate(turn[::-1])[::-1]
    out = np.ones(n, bool)
    out[:-1] = s[turn] < s[np.minimum(turn + 1, n - 1)]
    return out


def _placed(at: np.ndarray, letters: np.ndarray, positions: np.ndarray, order: np.ndarray, step: int) -> None:
    """Put ``positions`` into their letters' buckets in the given order; ``at`` moves by ``step`` each time."""
    by = np.argsort(letters, kind="stable")
    letters, positions = letters[by], positions[by]
    start = np.flatnonzero(np.concatenate([[True], letters[1:] != letters[:-1]]))
    count = np.diff(np.concatenate([start, [len(letters)]]))
    rank = np.arange(len(letters)) - np.repeat(start, count)
    order[at[letters] + step * rank] = positions
    at[letters[start]] += step * count


def _induced(s: np.ndarray, small: np.ndarray, marks: np.ndarray, letters: int) -> np.ndarray:
    """The suffix order that follows from the order of ``marks``, the leftmost smaller suffixes.

    Buckets are passed from left to right for the larger-than-next suffixes and
    back for the others; what one bucket induces is placed in one step, and again
    while a run of one letter induces into its own bucket.
    """
    size = np.bincount(s, minlength=letters)
    end = np.cumsum(size)
    head = end - size
    larger = np.bincount(s[~small], minlength=letters)
    order = np.full(len(s), -1, np.int64)
    by = marks[np.argsort(s[marks], kind="stable")]
    held = np.bincount(s[by], minlength=letters)
    held_from = np.cumsum(held) - held

    def preceding(found: np.ndarray, kind: bool) -> np.ndarray:
        before = found[found > 0] - 1
        return before[small[before] == kind]

    at = head.copy()
    for c in np.flatnonzero(size):
        done = head[c]
        while done < at[c]:
            found, done = order[done : at[c]], at[c]
            if len(before := preceding(found, False)):
                _placed(at, s[before], before, order, 1)
        if held[c] and len(before := preceding(by[held_from[c] : held_from[c] + held[c]], False)):
            _placed(at, s[before], before, order, 1)
    at = end - 1
    order[at[s[-1]]] = len(s) - 1
    at[s[-1]] -= 1
    for c in np.flatnonzero(size)[::-1]:
        done = end[c] - 1
        while done > at[c]:
            found, done = order[at[c] + 1 : done + 1][::-1], at[c]
            if len(before := preceding(found, True)):
                _placed(at, s[before], before, order, -1)
        if larger[c] and len(before := preceding(order[head[c] : head[c] + larger[c]][::-1], True)):
            _placed(at, s[before], before, order, -1)
    return order


def _induced_singly(s: np.ndarray, small: np.ndarray, marks: np.ndarray, letters: int) -> np.ndarray:
    """The same, one suffix after the other; for many small buckets.

    ``before`` has the letter that precedes a suffix where that suffix is of the kind a
    pass places, else -1; its last entry answers for places that are still empty.
    """
    n = len(s)
    size = np.bincount(s, minlength=letters)
    end = np.cumsum(size)
    order = np.full(n, -1, np.int32)
    _placed(end - 1, s[marks[::-1]], marks[::-1], order, -1)
    order = array("i", order.tobytes())
    before = np.full(n + 1, -1, np.int32)
    letter = s[:-1].astype(np.int32)  # signed, also where the letters are not
    before[1:n] = np.where(small[:-1], -1, letter)
    known, at = array("i", before.tobytes()), (end - size).tolist()
    for p in order:
        c = known[p]
        if c >= 0:
            k = at[c]
            order[k] = p - 1
            at[c] = k + 1
    before[1:n] = np.where(small[:-1], letter, -1)
    known, at = array("i", before.tobytes()), (end - 1).tolist()
    for p in reversed(order):
        c = known[p]
        if c >= 0:
            k = at[c]
            order[k] = p - 1
            at[c] = k - 1
    return np.frombuffer(order, np.int32).astype(np.int64)


def ragged(size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For ranges of the given sizes on end: the range of each element and its place in it."""
    of = np.repeat(np.arange(len(size)), size)
    return of, np.arange(len(of)) - np.repeat(np.cumsum(size) - size, size)


def _names(s: np.ndarray, marks: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    """Ranks of the substrings between marks, in text order; those of equal letters share a rank.

    In the order of the substrings each is held against the one before, letter by letter.
    """
    stop = np.minimum(np.concatenate([marks[1:], marks[-1:]]) + 1, len(s))
    place = np.searchsorted(marks, ordered)
    begin, length = marks[place], (stop - marks)[place]
    new = np.ones(len(marks), bool)
    alike = np.flatnonzero(length[1:] == length[:-1]) + 1
    total = np.concatenate([[0], np.cumsum(length[alike])])
    done = 0
    while done < len(alike):
        stop = max(done + 1, int(np.searchsorted(total, total[done] + READ, "right")) - 1)
        some = alike[done:stop]
        of, inner = ragged(length[some])
        same = s[begin[some][of] + inner] == s[begin[some - 1][of] + inner]
        new[some] = ~np.logical_and.reduceat(same, total[done:stop] - total[done])
        done = stop
    new[0] = False
    out = np.empty(len(marks), np.int64)
    out[place] = np.cumsum(new)
    return out


def suffix_array(text: np.ndarray, letters: int = 256) -> np.ndarray:
    """Start positions of all suffixes of ``text`` (integers below ``letters``) in their order.

    Suffixes are classified against their right neighbour; the substrings between
    leftmost smaller ones are sorted by induction and named; the string of names
    is ordered in turn; from its order all other suffixes are induced.
    """
    if len(text) == 0:
        return np.zeros(0, np.int64)
    s = np.concatenate([text.astype(np.int64) + 1, [0]])
    s = s.astype(np.uint16 if letters < 65535 else np.int64)
    return _ordered(s, letters + 1)[1:]


def _ordered(s: np.ndarray, letters: int) -> np.ndarray:
    induced = _induced if letters <= MOST_BUCKETS else _induced_singly
    small = _smaller_than_next(s)
    marks = np.flatnonzero(small[1:] & ~small[:-1]) + 1
    order = induced(s, small, marks, letters)
    if len(marks) > 1:
        is_mark = np.zeros(len(s), bool)
        is_mark[marks] = True
        names = _names(s, marks, order[is_mark[order]])
        count = int(names.max()) + 1
        within = np.argsort(names) if count == len(names) else _ordered(names, count)
        order = induced(s, small, marks[within], letters)
    return order


def equal_stretches(data: np.ndarray, a: np.ndarray, b: np.ndarray, length: int) -> np.ndarray:
    """Whether ``length`` letters from ``a`` and from ``b`` are equal, by the letters; ``a`` rises.

    Pairs that move on together by one letter are read as one stretch.
    """
    if len(a) == 0:
        return np.zeros(0, bool)
    first = np.flatnonzero(np.concatenate([[True], (a[1:] != a[:-1] + 1) | (b[1:] != b[:-1] + 1)]))
    pairs = np.diff(np.append(first, len(a)))
    total = np.concatenate([[0], np.cumsum(pairs + length - 1)])
    out, done = [], 0
    while done < len(pairs):
        stop = max(done + 1, int(np.searchsorted(total, total[done] + READ, "right")) - 1)
        part, start = pairs[done:stop], first[done:stop]
        of, inner = ragged(part + length - 1)
        wrong = np.concatenate([[0], np.cumsum(data[a[start][of] + inner] != data[b[start][of] + inner])])
        stretch, place = ragged(part)
        at = (total[done:stop] - total[done])[stretch] + place
        out.append(wrong[at + length] == wrong[at])
        done = stop
    return np.concatenate(out)


def permuted_prefixes(data_hash, starts: np.ndarray, order: np.ndarray, most: int = 127, letters: np.ndarray | None = None, least: int = 0) -> np.ndarray:
    """Common prefix of each start with the start before it in suffix order, cut at ``most``, in text order.

    ``data_hash`` gives hashes of byte ranges, ``order`` sorts ``starts``, which rise. Prefixes
    are grown by halving steps for all starts at once. With ``letters``, prefixes of
    ``least`` and more are read again letter by letter; one that is none counts as 0.
    """
    before = np.full(len(starts), -1, np.int64)
    before[order[1:]] = order[:-1]
    out = np.zeros(len(starts), np.int64)
    have = np.flatnonzero(before >= 0)
    a, b = starts[have], starts[before[have]]
    grown = np.zeros(len(have), np.int64)
    step = (most + 1) // 2
    while step:
        same = data_hash.of(a + grown, a + grown + step) == data_hash.of(b + grown, b + grown + step)
        grown[same] += step
        step //= 2
    if letters is not None:
        long = np.flatnonzero(grown >= least)
        grown[long[~equal_stretches(letters, a[long], b[long], least)]] = 0
    out[have] = grown
    return out
