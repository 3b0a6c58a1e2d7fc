"""The trie of conversations against one that is built in plain Python."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from orderlake.llm import prefix_trie as trie

SCHEMA = "conv_id long, turn long, role string, text string, depth long, last string, k1 string, block string"


def by_hand(rows):
    """Rows of the contract from (conv_id, turn, role, text)."""
    turns = defaultdict(list)
    for conv, turn, role, text, *_ in rows:
        if conv is not None:
            turns[conv].append((turn is not None, turn or 0, role or "", text or ""))
    turns = {c: [t[2:] for t in sorted(x)] for c, x in turns.items()}
    rebuilt = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 6
        first = c - (abs(c) % 100) * (1 if c >= 0 else -1)
        rebuilt[c] = tuple(turns.get(first, [])[:h] + own[h:])
    members = defaultdict(list)
    for c, x in rebuilt.items():
        for d in range(len(x) + 1):
            members[x[:d]].append(c)
    children = defaultdict(set)
    for x in members:
        if x:
            children[x[:-1]].add(x)
    leaves, saved = defaultdict(int), defaultdict(int)
    for x, own in members.items():
        for d in range(len(x) + 1):
            leaves[x[:d]] += not children[x]
            saved[x[:d]] += (len(own) - 1) * len(x[-1][1]) if x else 0
    out = []
    for x, own in members.items():
        ending = ",".join(str(c) for c in sorted(own) if len(rebuilt[c]) == len(x))
        above = min(members[x[:-1]]) if x else None
        out.append((min(own), len(x), above, len(own), len(children[x]), leaves[x], saved[x], hashlib.sha256(ending.encode()).hexdigest()))
    return sorted(out, key=repr)


def of(spark, rows):
    df = trie.prefix_trie(spark.createDataFrame([(*r, 1, "l", "k", "b") for r in rows], SCHEMA))
    assert df.columns == "conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens ends_sha256".split()
    return sorted((tuple(r) for r in df.collect()), key=repr)


def some(seed, convs, depth, texts):
    r = random.Random(seed)
    ids = r.sample(range(-150, 420), convs)
    rows = [(c, t, r.choice(["user", "assistant", None]), r.choice(texts)) for c in ids for t in range(r.randint(1, depth))]
    r.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", range(4))
def test_random(spark, seed):
    rows = some(seed, 120, 4 + 3 * seed, ["a", "bb", "", None, "é😀"][: 2 + seed])
    assert of(spark, rows) == by_hand(rows)


def test_conversations_over_many_blocks(spark, monkeypatch):
    """Blocks of few turns: conversations begin, go on and end in others."""
    monkeypatch.setattr(trie, "BLOCK", 3)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2")
    try:
        r = random.Random(5)
        rows = [(c, t, "user", r.choice("ab")) for c in (100, 101, 107, 200, 203, 205) for t in range(r.choice([1, 2, 9, 40]))]
        rows += [(9, t, "user", "ab"[t % 7 == 3]) for t in range(60)] + [(8, t, "user", "ab"[t % 7 == 3]) for t in range(61)]
        assert trie.blocks_of_turns(spark.createDataFrame([(*r, 1, "l", "k", "b") for r in rows], SCHEMA)).count() > 20
        assert of(spark, rows) == by_hand(rows)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_full_counters(spark, monkeypatch):
    """Where every counter says two, all prefixes are grouped and the rows are the same."""
    monkeypatch.setattr(trie, "LANES", 1)
    monkeypatch.setattr(trie, "_cells", lambda k1, k2, cells: [k1.view("u8").astype("i8") & 3])
    rows = some(11, 90, 9, ["a", "bb"])
    assert of(spark, rows) == by_hand(rows)


def test_odd_rows(spark):
    copies = [(c, t, "user", f"t{t}") for c in range(300, 400) for t in range(6)]
    rows = copies + [(None, 1, "user", "x"), (7, None, None, None), (7, 1, "", ""), (7, 1, "", ""), (0, None, "user", "long " * 200_000), (5, 0, "user", "z"), (150, 3, None, "only")]
    assert of(spark, rows) == by_hand(rows)
    assert of(spark, []) == []


def test_whole_table(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    expected = by_hand([tuple(r) for r in table.select("conv_id", "turn", "role", "text").collect()])
    assert sorted((tuple(r) for r in trie.prefix_trie(table).collect()), key=repr) == expected
