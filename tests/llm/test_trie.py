import hashlib
import random
import zlib

import pytest
from helpers import CLASHES

from streamgauge.llm import queries, trie

SCHEMA = "conv_id long, turn long, role string, text string, " + ", ".join(f"`{c}` string" for c in CLASHES)


def turns_of(spark, rows):
    return spark.createDataFrame([(*r, *["?"] * len(CLASHES)) for r in rows], SCHEMA).repartition(3)


def sequences(rows):
    out = {}
    for c, t, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            out.setdefault(c, []).append(((t is not None, t), hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()[:32], (role, text)))
    return {c: [x for _, _, x in sorted(v)] for c, v in out.items()}


def by_hand(seqs):
    """Every node with the list of its members."""
    members = {}
    for c, seq in seqs.items():
        for d in range(len(seq) + 1):
            members.setdefault(tuple(seq[:d]), []).append(c)
    kids = {}
    for path in members:
        if path:
            kids.setdefault(path[:-1], []).append(path)
    leaves, saved = {}, {}
    for path in sorted(members, key=len, reverse=True):
        own = (len(members[path]) - 1) * len(path[-1][1].encode()) if path else 0
        leaves[path] = sum(leaves[k] for k in kids.get(path, [])) or 1
        saved[path] = own + sum(saved[k] for k in kids.get(path, []))
    out = []
    for path, who in members.items():
        ends = ",".join(str(c) for c in sorted(c for c in who if len(seqs[c]) == len(path)))
        parent = min(members[path[:-1]]) if path else None
        out.append((min(who), len(path), parent, len(who), len(kids.get(path, [])), leaves[path], saved[path], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out)


def collected(df):
    names = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return sorted(tuple(r[n] for n in names) for r in df.collect())


def conversations(seed, n, longest):
    dice = random.Random(seed)
    said = [("user", "hi"), ("user", "é"), ("assistant", "hi"), (None, None), ("", "x"), ("u", "serhi")]
    known, rows = [], []
    for c in range(n):
        seq = list(dice.choice(known)[: dice.randint(0, longest)]) if known and dice.random() < 0.8 else []
        seq += [dice.choice(said) for _ in range(dice.randint(0, longest - len(seq)) if dice.random() < 0.7 else 0)]
        known.append(seq)
        rows += [(c * 3 - 20, t * 2, *x) for t, x in enumerate(seq)]
    dice.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed,n,longest,chunk,piece", [(1, 60, 9, 64, 4096), (2, 40, 70, 2, 7), (3, 25, 40, 1, 1), (4, 12, 20, 64, 16)])
def test_equals_members_by_hand(spark, monkeypatch, seed, n, longest, chunk, piece):
    monkeypatch.setattr(trie, "CHUNK", chunk if chunk > 1 else 2)
    monkeypatch.setattr(trie, "PIECE", piece)
    rows = conversations(seed, n, longest)
    placed = trie.placed_turns(turns_of(spark, rows))
    turnless = [(10_000,), (10_001,)]
    convs = placed.select("conv_id").union(spark.createDataFrame(turnless, "conv_id long"))
    got = collected(trie.prefix_tree(placed, convs))
    assert got == by_hand(sequences(rows) | {c: [] for (c,) in turnless})


def test_odd_rows(spark):
    rows = [(5, None, "user", "a"), (5, 0, "user", "b"), (5, 0, "user", "b"), (6, None, None, None), (None, 1, "user", "lost"), (7, 3, "", ""), (8, 1, "use", "ra"), (9, 1, "user", "a")]
    placed = trie.placed_turns(turns_of(spark, rows))
    assert collected(trie.prefix_tree(placed, placed.select("conv_id"))) == by_hand(sequences(rows))


def test_copies_of_one_conversation(spark):
    rows = [(c, t, "user", f"turn {t}") for c in range(300) for t in range(20)]
    placed = trie.placed_turns(turns_of(spark, rows))
    got = collected(trie.prefix_tree(placed, placed.select("conv_id")))
    assert got == by_hand(sequences(rows)) and len(got) == 21


def test_empty(spark):
    placed = trie.placed_turns(turns_of(spark, []))
    assert trie.prefix_tree(placed, placed.select("conv_id")).collect() == []


def test_query_equals_its_contract_by_hand(spark, tmp_path):
    dice = random.Random(8)
    rows = [(c, t, dice.choice(["user", "assistant"]), dice.choice("abc")) for c in range(70) if c % 7 for t in range(dice.choice([1, 2, 3, 8, 12, 30]))]
    turns_of(spark, rows).write.parquet(f"{tmp_path}/conversations.parquet")
    seqs = sequences(rows)
    rebuilt = {}
    for c, seq in seqs.items():
        h = zlib.crc32(str(c).encode()) % 9
        rebuilt[c] = seqs.get(c - c % 5, [])[:h] + seq[h:]
    assert any(not s for s in rebuilt.values())
    assert collected(queries.op11_trie(spark, str(tmp_path))) == by_hand(rebuilt)
