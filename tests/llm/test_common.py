import numpy as np
import pyarrow as pa
from helpers import words

from streamgauge.llm.common import Rolling, slices, text_bytes, words_of

TEXTS = ["a  b\tc", None, "", " x", "é\x0bÜ z ", "tail", "A\x1fB"]


def test_words_of_rows_on_end():
    data, borders = text_bytes(pa.array(TEXTS))
    starts, ends, row = words_of(data, borders)
    got = [[bytes(data[s:e]).lower() for s, e, r in zip(starts, ends, row) if r == i] for i in range(len(TEXTS))]
    assert got == [words(t) for t in TEXTS]


def test_equal_bytes_have_equal_hashes_wherever_they_stand():
    data = np.frombuffer(b"xxabcabyyabcab", np.uint8)
    known = Rolling(data)
    a, b, c = known.of(np.array([2, 9, 3]), np.array([7, 14, 8]))
    assert a == b != c
    assert Rolling(np.frombuffer(b"AbC", np.uint8), folded=True).of(np.array([0]), np.array([3])) == Rolling(np.frombuffer(b"abc", np.uint8)).of(np.array([0]), np.array([3]))


def test_slices_keep_every_row_and_long_ones_whole():
    batch = pa.RecordBatch.from_pydict({"text": ["a" * 5, None, "b" * 50, "c", ""]})
    parts = list(slices(iter([batch, batch.slice(0, 0)]), "text", 8))
    assert sum((p.column("text").to_pylist() for p in parts), []) == batch.column("text").to_pylist()
    assert max(p.num_rows for p in parts) < 5
