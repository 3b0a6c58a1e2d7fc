"""Spelling variants: words of a vocabulary that are one edit apart, and the form each belongs to.

1. *Words.* Runs of letters are counted text by text in Arrow functions, so that a task sends each
   word once for many texts, and then summed up. Rare and short words go.
2. *Partitions.* An edit happens at one place: the end of the common beginning. The places of a
   word are halved; words that agree in all but one half, so in half of their letters, start the
   composition in the same state and form a partition. Partitions are counted first; one with more
   than `LETTERS` letters in its half is halved again, and so on down to one place, where a
   partition has at most as many words as there are letters, plus one.
3. *Composition.* In a partition the halves become a minimised acceptor (a deterministic automaton
   without equal states). Composed with the transducer that makes one edit, and with itself, it
   accepts the near pairs: before the edit both sides are in one state, at the edit they part, and
   afterwards they read the same letters from two states. What two states have in common is worked
   out once for each pair of states. Words are numbered by the acceptor, so pairs are numbers.
4. *Forms.* Each word meets its near words' count and best one. Roots come from following forms
   twice as far each time; counts at least double along a chain, so it has at most 63 steps.

Rows: one per word. A NULL text has no words, and a NULL doc_id counts as an empty one where the
deletion is drawn. Repeated rows count each time. Texts and words may have any length. Other
columns are not read. An empty table gives an empty result. Ties go to the smallest word in
code-point order.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlake.llm.common import stored
from orderlake.llm.tokens import by_bytes

RUN = re.compile("[A-Za-zÀ-ÿ]+")
LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}
DAMAGED = 97  # one run in so many loses a letter
LEAST_LENGTH, LEAST_COUNT = 5, 3
COUNTED = 1 << 18  # words a task counts before it sends them, and 16 times as many letters
LETTERS = 1 << 16  # letters of a partition's halves at most

_KEY = ["size", "lo", "hi", "head", "tail"]


def run_as_word(doc_id: int | None, run: str) -> str:
    """A lower-cased run, without one letter where the checksum says so."""
    h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
    if h % DAMAGED:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1 :]


def vocabulary(docs: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT) -> DataFrame:
    """`word`, `n` of all words that are long and frequent enough."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, int] = {}
        lowered: dict[str, str] = {}
        letters = 0
        for batch in batches:
            for part in by_bytes(batch, "text"):
                for doc, text in zip(*(c.to_pylist() for c in part.columns)):
                    own: dict[str, int] = {}
                    for run, n in Counter(m[0] for m in RUN.finditer(text)).items() if len(text) > COUNTED else Counter(RUN.findall(text)).items():
                        low = lowered.get(run)
                        if low is None:
                            low = run.translate(LOWER)
                            if len(run) < 32:
                                lowered[run] = low
                        own[low] = own.get(low, 0) + n
                    for low, n in own.items():
                        word = run_as_word(doc, low)
                        if len(word) >= least_length:
                            if word not in total:
                                letters += len(word)
                            total[word] = total.get(word, 0) + n
                if len(total) > COUNTED or letters > 16 * COUNTED:
                    yield _counted(total)
                    total, letters = {}, 0
                if len(lowered) > COUNTED:
                    lowered = {}
        yield _counted(total)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    counted = rows.where("text is not null").mapInArrow(count, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


def _counted(total: dict[str, int]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())], names=["word", "n"])


def halved(rows: DataFrame) -> DataFrame:
    """Each row of a partition in both halves of its places. `size` is the length of the longer
    word of a pair, [lo, hi) the places where the edit may be; `head` and `tail` are the letters
    before and after, `middle` those in between; a `short` word lacks one of them."""
    mid = (F.col("lo") + F.col("hi")).cast("int") / 2
    mid = F.floor(mid).cast("int")
    first, short = mid - F.col("lo"), F.col("short")
    middle = F.col("middle")

    def piece(lo: Column, hi: Column, head: Column, inner: Column, tail: Column) -> Column:
        return F.struct(lo.alias("lo"), hi.alias("hi"), head.alias("head"), inner.alias("middle"), tail.alias("tail"))

    def after(n: Column) -> Column:
        return F.substr(middle, n + 1)

    left = piece(F.col("lo"), mid, F.col("head"), F.substr(middle, F.lit(1), first - short), F.concat(after(first - short), F.col("tail")))
    right = piece(mid, F.col("hi"), F.concat(F.col("head"), F.substr(middle, F.lit(1), first)), after(first), F.col("tail"))
    return rows.withColumn("half", F.explode(F.array(left, right))).select("size", "half.*", "short", "n")


class Acceptor:
    """The minimised automaton of sorted, distinct words; states come after those they lead to, and
    words are numbered in their order."""

    def __init__(self, words: list[str]):
        self.final: list[bool] = []
        self.edges: list[list[tuple[str, int, int]]] = []  # label, state, number of its first word
        self.count: list[int] = []
        register: dict[tuple, int] = {}

        def registered(node: list) -> int:
            key = (node[0], *node[1])
            state = register.get(key)
            if state is None:
                state = register[key] = len(self.final)
                at, edges = int(node[0]), []
                for label, to in node[1]:
                    edges.append((label, to, at))
                    at += self.count[to]
                self.final.append(node[0])
                self.edges.append(edges)
                self.count.append(at)
            return state

        path: list[list] = [[False, []]]  # of the last word: whether it ends here, and its edges
        before = ""
        for word in words:
            shared = 0
            for a, b in zip(before, word):
                if a != b:
                    break
                shared += 1
            self._close(path, before, shared, registered)
            path += [[False, []] for _ in range(len(word) - shared)]
            path[-1][0] = True
            before = word
        self._close(path, before, 0, registered)
        self.start = registered(path[0])

    @staticmethod
    def _close(path: list, word: str, keep: int, registered) -> None:
        while len(path) > keep + 1:
            node = path.pop()
            path[-1][1].append((word[len(path) - 1], registered(node)))


class Composition:
    """Acceptor, one edit, acceptor: pairs of word numbers that are accepted."""

    def __init__(self, acceptor: Acceptor, following: str):
        self.a, self.following = acceptor, following
        self.shared: dict[tuple[int, int], list[tuple[int, int]]] = {}

    def common(self, p: int, q: int) -> list[tuple[int, int]]:
        """Numbers, in both states, of the words that both accept."""
        todo = [(p, q)]
        edges, final = self.a.edges, self.a.final
        while todo:
            x, y = pair = todo[-1]
            if pair in self.shared:
                todo.pop()
            elif x == y:
                self.shared[pair] = [(i, i) for i in range(self.a.count[x])]
            else:
                of_y = {label: (to, at) for label, to, at in edges[y]}
                both = [(to, at, *of_y[label]) for label, to, at in edges[x] if label in of_y]
                missing = [(to, other) for to, _, other, _ in both if (to, other) not in self.shared]
                if missing:
                    todo += missing
                    continue
                found = [(0, 0)] if final[x] and final[y] else []
                for to, at, other, other_at in both:
                    found += [(at + i, other_at + j) for i, j in self.shared[to, other]]
                self.shared[pair] = found
        return self.shared[p, q]

    def pairs(self) -> list[tuple[int, int]]:
        """Near pairs: of equal length, or the longer word first."""
        near: list[list[tuple[int, int]]] = []
        for p, edges in enumerate(self.a.edges):
            found = []
            for n, (label, to, at) in enumerate(edges):
                found += [(at + i, at + j) for i, j in near[to]]
                for _, other, other_at in edges[n + 1 :]:  # replaced
                    found += [(at + i, other_at + j) for i, j in self.common(to, other)]
                # Deleted: what follows must not begin with the same letter, else the edit is later.
                own = range(at, at + self.a.count[to])
                for i, j in self.common(to, p):
                    ends = self.a.final[p] and j == 0
                    if self.following != label if ends else j not in own:
                        found.append((at + i, j))
            near.append(found)
        return near[self.a.start]


def near_in_partition(words: dict[str, int], hi: int, lo: int, tail: str) -> Iterator[tuple[str, str]]:
    """Near pairs of the middles of a partition whose edit lies in [lo, hi)."""
    ordered = sorted(words)
    for i, j in Composition(Acceptor(ordered), tail[:1]).pairs():
        # two short words are near in the partition of their own length
        if max(len(ordered[i]), len(ordered[j])) == hi - lo:
            yield ordered[i], ordered[j]


def _best(old: tuple[int, int, str] | None, n: int, word: str) -> tuple[int, int, str]:
    if old is None:
        return 1, n, word
    return (old[0] + 1, n, word) if (-n, word) < (-old[1], old[2]) else (old[0] + 1, *old[1:])


def compose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by partition: of each word the number of its near words and the best one."""
    key, words = None, {}

    def done() -> list[tuple]:
        if len(words) < 2:
            return []
        size, lo, hi, head, tail = key
        found: dict[str, tuple[int, int, str]] = {}
        # Ties go by whole words: without its tail, a middle that begins another one always comes first.
        for x, y in near_in_partition(words, hi, lo, tail):
            found[x] = _best(found.get(x), words[y], y + tail)
            found[y] = _best(found.get(y), words[x], x + tail)
        return [(head + x + tail, n, best_n, head + best) for x, (n, best_n, best) in found.items()]

    def made(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows)) or [()] * 4
        kinds = (pa.string(), pa.int64(), pa.int64(), pa.string())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["word", "n_near", "best_n", "best"])

    for batch in batches:
        out = []
        for *own, middle, n in zip(*(c.to_pylist() for c in batch.columns)):
            if own != key:
                out += done()
                key, words = own, {}
            words[middle] = n
        yield made(out)
    yield made(done())


def near_words(words: DataFrame, letters: int = LETTERS) -> DataFrame:
    """`word`, `n_near`, `best_n`, `best` of the words of a stored vocabulary that have near ones."""
    length = F.char_length("word")
    both = F.explode(F.array(F.lit(0), F.lit(1))).alias("short")
    rows = words.select("word", "n", both).select(
        (length + F.col("short")).alias("size"), F.lit(0).alias("lo"), (length + F.col("short")).alias("hi"),
        F.lit("").alias("head"), F.col("word").alias("middle"), F.lit("").alias("tail"), "short", "n",
    )
    found = []
    while True:
        rows = stored(halved(rows), "halves")
        many = rows.groupBy(*_KEY).agg(F.count(F.lit(1)).alias("members"), F.sum(F.char_length("middle")).alias("letters"))
        many = stored(many.where("members > 1"), "partitions")
        hot = F.col("hi") - F.col("lo") > 1
        hot &= F.col("letters") > letters
        met = rows.join(many, _KEY)
        found.append(met.where(~hot).select(*_KEY, "middle", "n"))
        if many.where(hot).isEmpty():
            break
        rows = met.where(hot).select(*rows.columns)
    parts = found[0]
    for more in found[1:]:
        parts = parts.unionByName(more)
    parts = parts.repartition(*_KEY).sortWithinPartitions(*_KEY)
    near = parts.mapInArrow(compose, "word string, n_near long, best_n long, best string")
    best = F.min(F.struct((-F.col("best_n")).alias("n"), F.col("best").alias("word"))).alias("best")
    near = near.groupBy("word").agg(F.sum("n_near").alias("n_near"), best)
    return near.select("word", "n_near", (-F.col("best.n")).alias("best_n"), F.col("best.word").alias("best"))


def roots(forms: DataFrame) -> DataFrame:
    """`word`, `root` of stored `word`, `form`: each round follows the way that is known twice."""
    known = forms.select("word", F.col("form").alias("root"))
    while True:
        further = known.select(F.col("word").alias("root"), F.col("root").alias("next"))
        step = stored(known.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        known = step.select("word", "root")
        if step.where("moved").isEmpty():
            return known


def spelling_variants(docs: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT) -> DataFrame:
    """`word`, `form`, `root`, `n`, `n_near`, `form_n` of every word of the vocabulary."""
    words = stored(vocabulary(docs, least_length, least_count), "vocabulary")
    fits = F.col("best_n") >= 2 * F.col("n")
    rows = words.join(near_words(words), "word", "left").select(
        "word", F.when(fits, F.col("best")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(fits, F.col("best_n")).alias("form_n"),
    )
    rows = stored(rows, "variants")
    found = roots(rows.where("form is not null").select("word", "form"))
    result = rows.join(found, "word", "left").withColumn("root", F.coalesce("root", "word"))
    return result.select("word", "form", "root", "n", "n_near", "form_n")
