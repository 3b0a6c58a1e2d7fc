"""Spelling variants against a plain version that tries every edit of every word."""

import random
import re
import zlib
from collections import Counter

import pytest

from orderlake.llm import spelling
from llm.cases import SCHEMA, no_documents, odd_documents, odd_rows, tuples

ALPHABET = [chr(c) for c in [*range(97, 123), *range(0xC0, 0x100)]]


def edits(word):
    for i in range(len(word) + 1):
        rest = word[i:]
        yield from (word[:i] + c + rest for c in ALPHABET)
        if rest:
            yield word[:i] + rest[1:]
            yield from (word[:i] + c + rest[1:] for c in ALPHABET)


def near_by_hand(n):
    return {w: sorted({e for e in edits(w) if e in n and e != w}) for w in n}


def by_hand(docs):
    n = Counter()
    for doc, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 97 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            n[run] += 1
    n = {w: k for w, k in n.items() if len(w) >= 5 and k >= 3}
    near = near_by_hand(n)
    form = {}
    for w in n:
        best = min(near[w], key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= 2 * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n[w], len(near[w]), n.get(form[w])))
    return sorted(out, key=repr)


def some_words(seed, many, letters="ab", longest=9):
    r = random.Random(seed)
    return {"".join(r.choice(letters) for _ in range(r.randint(5, longest))): r.randint(1, 99) for _ in range(many)}


@pytest.mark.parametrize("letters", [1 << 16, 40, 1])
def test_near_words(spark, letters):
    """The same pairs whether partitions are large or halved down to single places."""
    n = some_words(1, 150) | some_words(2, 150, "abcé×", 7) | {"a" * k: k for k in range(5, 30)} | {"ab" * 40 + "c": 3, "ab" * 40: 4}
    words = spelling.stored(spark.createDataFrame(list(n.items()), "word string, n long"), "words")
    found = {r.word: (r.n_near, r.best_n, r.best) for r in spelling.near_words(words, letters).collect()}
    expected = {}
    for w, near in near_by_hand(n).items():
        if near:
            best = min(near, key=lambda x: (-n[x], x))
            expected[w] = (len(near), n[best], best)
    assert found == expected


def test_acceptor_is_minimal_and_numbers_words():
    words = sorted(some_words(3, 400, "abc", 8))
    a = spelling.Acceptor(words)
    assert len(set(zip(a.final, map(tuple, a.edges)))) == len(a.final)
    for number, word in enumerate(words):
        state, at = a.start, 0
        for c in word:
            state, at = next((to, at + first) for label, to, first in a.edges[state] if label == c)
        assert a.final[state] and at == number


def test_documents(spark):
    r = random.Random(9)
    stems = ["farbe", "colour", "color", "colours", "grün", "gruen", "Straße", "strase", "theater", "theatre", "ÀÉÎÕÜ", "àéîõü", "x×y÷z"]
    texts = [(r.choice([None, *range(40)]), " ".join(r.choice(stems) + r.choice(["", "", "s", "e", "-", "1"]) for _ in range(120))) for _ in range(60)]
    long = "verylongword" * 4000
    texts += [(1, f"{long} {long} {long}, {long[:-1]} {long[:-1]} {long[1:]}"), (2, f"{long}x {long} {long[:-1]}"), (3, None), (4, "")] * 3
    docs = spark.createDataFrame([(i, t, "en", "s", 1, 1, "l", "r", "k", 9, "c") for i, t in texts], SCHEMA)
    hand = by_hand([(i, t) for i, t in texts if long not in (t or "")])
    found = tuples(spelling.spelling_variants(docs))
    assert [x for x in found if len(x[0]) < 100] == hand
    # 12, 9, 3 and 3 occurrences; the second is near the first, but more than half as frequent
    expected = {(long, None, 12, 3, None), (long[:-1], None, 9, 1, None), (long[1:], long, 3, 1, 12), (long + "x", long, 3, 1, 12)}
    assert {(w, form, n, near, form_n) for w, form, _, n, near, form_n in found if len(w) > 100} == expected


def test_odd_documents(spark):
    docs = odd_documents(spark)
    three = docs.union(docs).union(docs)
    expected = by_hand([(r[0], r[1]) for r in odd_rows()] * 3)
    assert [x for x in tuples(spelling.spelling_variants(three)) if len(x[0]) < 600] == [x for x in expected if len(x[0]) < 600]
    assert spelling.spelling_variants(no_documents(spark)).collect() == []


def test_whole_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    assert tuples(spelling.spelling_variants(docs)) == by_hand([(r.doc_id, r.text) for r in docs.collect()])


def test_chains(spark):
    """Forms of forms, to the last one."""
    chain = [(str(i), str(i + 1)) for i in range(60)]
    table = spelling.stored(spark.createDataFrame(chain, "word string, form string"), "chain")
    assert {r.root for r in spelling.roots(table).collect()} == {"60"}


def test_ties_go_by_whole_words(spark):
    """Near words of equal count, of which one's letters up to the end of the edit begin the other's."""
    n = {"abcdez": 1, "abdez": 9, "abccdez": 9, "abcdzzz": 2, "abcdzz": 8, "abcdzazz": 8}
    n |= {w: 5 for w in some_words(3, 400, "abz")}
    words = spark.createDataFrame(list(n.items()), "word string, n long")
    found = {r["word"]: (r["n_near"], r["best_n"], r["best"]) for r in spelling.near_words(words).collect()}
    near = {w: v for w, v in near_by_hand(n).items() if v}
    best = {w: min(v, key=lambda x: (-n[x], x)) for w, v in near.items()}
    assert found == {w: (len(v), n[best[w]], best[w]) for w, v in near.items()}
