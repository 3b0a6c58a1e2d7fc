"""Encoding and decoding by a word-level BPE file: speculate, verify, repair.

The file's normaliser runs on the text; its pre-tokenizer's pattern cuts the text into words, and
a word is encoded once, however often a worker meets it:

1. *Speculate.* Greedy longest match proposes tokens, from left to right.
2. *Verify.* A sequence of tokens is what merging yields exactly if each token is what merging
   makes of its own symbols and no two neighbours would have been joined across their border. The
   symbols at a border are the right edge of the left token's merge tree and the left edge of the
   right one's; a merge joins two of them if it comes before the merges that use them up. All
   neighbours of all proposals of a batch are tested at once, level by level of these edges.
3. *Repair.* Words that fail are merged by rank, with a heap, in n log n steps.

Decoding goes from ids back to token strings; the file has no decoder, so these are joined by
blanks, as its library does.

Rows: one per input row, also for repeated rows and ids. A NULL text counts as empty: no tokens.
An empty table gives an empty result; other columns are not read. Special strings in a text are
special tokens. Texts are encoded in stretches of about a megabyte that end before white space
after other characters, where neither normaliser nor pattern reaches across; a longer stretch
without such a place is one piece, whose words are taken in batches. What a worker keeps of words
is bounded, in number and in length.
"""

from __future__ import annotations

import hashlib
import json
import re
from array import array
from collections.abc import Iterator
from functools import cache
from heapq import heapify, heappop, heappush
from itertools import chain, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlake.llm.tokens import by_bytes, tokenizer_path

TOKENIZER = "word_bpe_49k.json"
STRETCH = 1 << 20  # characters of a text in work at a time
WORDS = 1 << 17  # words in work at a time
REMEMBERED = 1 << 19  # words a worker remembers
SHORT = 24  # so many symbols are merged by looking for the first merge again and again
BEGIN = 4  # characters by which the longest token that may follow is looked up
LONG = 64  # longer words are not remembered

# What the file says of texts, as far as the short way for ASCII knows it.
_NORMALIZERS = [
    {"type": "NFC"},
    {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "},
    {"type": "Lowercase"},
]
_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_ASCII_PATTERN = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^\sa-z0-9]+", re.ASCII)

_CUT = re.compile(r"(?<=[^\s])[ \n\r\t]")


class MergeTable:
    """Merges by rank, and what borders of tokens look like.

    A merged token's id grows with its rank and exceeds those of its parts, so ids serve as ranks.
    Symbols are characters; a word's last symbol carries the end mark.
    """

    def __init__(self, vocab: dict[str, int], merges: list[tuple[str, str]], end: str):
        self.end, self.vocab = end, vocab
        size = max(vocab.values()) + 1
        self.tokens = [""] * size
        for token, i in vocab.items():
            self.tokens[i] = token
        self.left, self.right = np.full(size, -1, np.int64), np.full(size, -1, np.int64)
        self.merge: dict[tuple[int, int], int] = {}
        for a, b in merges:
            parts, made = (vocab[a], vocab[b]), vocab[a + b]
            if made <= max(parts) or self.left[made] >= 0:
                raise ValueError("ids of merged tokens must follow the order of merges")
            self.merge[parts] = made
            self.left[made], self.right[made] = parts
        made = sorted((a * size + b, i) for (a, b), i in self.merge.items())
        self.size = size
        self.pairs = np.array([p for p, _ in made], np.int64)
        self.results = np.array([i for _, i in made], np.int64)
        self._find_whole()

    def joined(self, a: np.ndarray, b: np.ndarray, before: np.ndarray) -> np.ndarray:
        """Whether merging joins something across the border of tokens `a` and `b`, by a merge
        that comes before `before`. On a tie the merge further to the left is made first."""
        found = np.zeros(len(a), bool)
        rows, x, used_x = np.arange(len(a)), a.copy(), before.copy()
        while len(rows):  # x goes down the right edge of a
            at, y, used_y = rows, b[rows], before[rows]
            cx, cu = x, used_x
            while len(at):  # y goes down the left edge of b
                pair = cx * self.size + y
                place = np.minimum(np.searchsorted(self.pairs, pair), len(self.pairs) - 1)
                made = np.where(self.pairs[place] == pair, self.results[place], self.size)
                found[at[(made < cu) & (made <= used_y)]] = True
                below = self.left[y]
                # what is used up before cx is there can't meet it, nor can anything below
                go = (below >= 0) & ~found[at] & (y > cx)
                at, cx, cu, used_y, y = at[go], cx[go], cu[go], y[go], below[go]
            below = self.right[x]
            go = (below >= 0) & ~found[rows]
            rows, used_x, x = rows[go], x[go], below[go]
        return found

    def _find_whole(self) -> None:
        """Which tokens merging makes of their own symbols: only these are ever proposed."""
        merged = np.flatnonzero(self.left >= 0)
        torn = self.joined(self.left[merged], self.right[merged], merged)
        whole = np.ones(self.size, bool)
        whole[merged[torn]] = False
        for i in merged.tolist():  # parts come before what is made of them
            whole[i] &= whole[self.left[i]] and whole[self.right[i]]
        self.inner = {t: i for t, i in self.vocab.items() if whole[i] and not t.endswith(self.end)}
        cut = len(self.end)
        self.final = {t[:-cut]: i for t, i in self.vocab.items() if whole[i] and t.endswith(self.end) and t != self.end}
        self.reach: dict[str, int] = {}  # the longest token that begins with these characters
        for token in self.inner:
            for n in range(1, min(len(token), BEGIN) + 1):
                self.reach[token[:n]] = max(self.reach.get(token[:n], 0), len(token))
        self.longest_final = max(map(len, self.final))

    def proposed(self, word: str) -> list[int]:
        """Greedy longest match; the token at the end must hold the word's last symbol."""
        ids, at, last = [], 0, len(word) - 1
        inner, final, reach = self.inner, self.final, self.reach
        while at <= last:
            if last + 1 - at <= self.longest_final and (i := final.get(word[at:])) is not None:
                ids.append(i)
                break
            longest = reach.get(word[at : at + BEGIN], BEGIN - 1)
            for stop in range(min(last, at + longest), at, -1):
                if (i := inner.get(word[at:stop])) is not None:
                    ids.append(i)
                    at = stop
                    break
            else:
                raise ValueError(f"no token begins at {word[at:at + 9]!r}")
        return ids

    def merged(self, word: str) -> list[int]:
        """Merging by rank, the leftmost of equal ones first."""
        ids = [self.vocab[s] for s in word[:-1]] + [self.vocab[word[-1] + self.end]]
        if len(ids) <= SHORT:
            rank, none = self.merge.get, self.size
            ranks = [rank(p, none) for p in zip(ids, ids[1:])]
            while ranks and (made := min(ranks)) < none:
                i = ranks.index(made)
                ids[i] = made
                del ids[i + 1], ranks[i]
                if i:
                    ranks[i - 1] = rank((ids[i - 1], made), none)
                if i < len(ranks):
                    ranks[i] = rank((made, ids[i + 1]), none)
            return ids
        after, before = list(range(1, len(ids) + 1)), list(range(-1, len(ids) - 1))
        heap = [(m, i, p) for i, p in enumerate(zip(ids, ids[1:])) if (m := self.merge.get(p)) is not None]
        heapify(heap)
        while heap:
            made, i, pair = heappop(heap)
            j = after[i]
            if j >= len(ids) or (ids[i], ids[j]) != pair:
                continue
            ids[i], ids[j] = made, -1
            after[i] = j = after[j]
            if j < len(ids):
                before[j] = i
                if (m := self.merge.get(p := (made, ids[j]))) is not None:
                    heappush(heap, (m, i, p))
            if (k := before[i]) >= 0 and (m := self.merge.get(p := (ids[k], made))) is not None:
                heappush(heap, (m, k, p))
        return [i for i in ids if i >= 0]

    def encoded(self, words: list[str]) -> tuple[list[list[int]], int]:
        """Ids of each word, and how many words had to be merged."""
        guesses = [self.proposed(w) for w in words]
        flat = np.fromiter((i for g in guesses for i in g), np.int64)
        of = np.repeat(np.arange(len(words)), [len(g) for g in guesses])
        inside = np.flatnonzero(of[1:] == of[:-1])
        border, back = np.unique(flat[inside] * self.size + flat[inside + 1], return_inverse=True)
        bad = self.joined(border // self.size, border % self.size, np.full(len(border), self.size))
        failed = np.unique(of[inside[bad[back]]])
        for w in failed.tolist():
            guesses[w] = self.merged(words[w])
        return guesses, len(failed)


class WordEncoder:
    """Ids of texts as the library for `.json` files gives them, and texts of ids."""

    def __init__(self, path: str):
        import regex
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            stated = json.load(file)
        self.library = Tokenizer.from_file(path)
        self.normalizer, self.cutter = self.library.normalizer, self.library.pre_tokenizer
        split, byte_level = stated["pre_tokenizer"]["pretokenizers"]
        usual = (split["type"], split["invert"], byte_level["type"], byte_level["use_regex"])
        if usual != ("Split", True, "ByteLevel", False) or byte_level["add_prefix_space"] or stated["decoder"]:
            raise ValueError(f"{path} is not a word-level BPE file")
        model = stated["model"]
        self.table = MergeTable(model["vocab"], [tuple(m) for m in model["merges"]], model["end_of_word_suffix"])
        self.pattern = regex.compile(split["pattern"]["Regex"])
        self.special = {t["content"]: t["id"] for t in stated["added_tokens"]}
        ordered = sorted(self.special, key=len, reverse=True)
        self.at_special = re.compile("(" + "|".join(map(re.escape, ordered)) + ")") if ordered else None
        self.strings = dict(enumerate(self.table.tokens)) | {i: t for t, i in self.special.items()}
        self.usual: set[str] = set()
        self.unusual: set[str] = set()
        self.ids_of: dict[str, bytes] = {}
        self.text_of: dict[str, str] = {}
        self.passing: list[str] = []
        self.of_byte = _byte_symbols()
        self.speculated = self.repaired = 0
        normalizers = (stated["normalizer"] or {}).get("normalizers")
        self.knows_ascii = normalizers == _NORMALIZERS and split["pattern"]["Regex"] == _PATTERN
        self.other_ascii = {c for c in map(chr, range(128)) if not self._same_class(c.lower(), _ASCII_PATTERN)}

    def decode(self, ids: list[int]) -> str:
        """The text of ids, special tokens included."""
        return " ".join([self.strings[i] for i in ids])

    def _same_class(self, c: str, pattern=None) -> bool:
        """Whether the pattern here, or another one, and the library's own cut around a character alike; their
        tables of letters may be of different years."""
        probe = f"a{c}1{c}!{c}"
        offsets = [tuple(o) for _, o in self.cutter.pre_tokenize_str(probe)]
        return offsets == [m.span() for m in (pattern or self.pattern).finditer(probe)]

    def words(self, text: str) -> Iterator[str]:
        """Words of a normalised text."""
        new = set(text) - self.usual
        if new:
            self.unusual |= {c for c in new if c not in self.unusual and not self._same_class(c)}
            self.usual |= new - self.unusual
        if new & self.unusual:
            back = str.maketrans({v: k for k, v in self.of_byte.items()})
            found = (w.translate(back).encode("latin-1") for w, _ in self.cutter.pre_tokenize_str(text))
            yield from (w.decode() for w in found)
        elif len(text) <= STRETCH:
            yield from self.pattern.findall(text)
        else:
            yield from (m[0] for m in self.pattern.finditer(text))

    def symbols(self, word: str) -> str:
        """A word as byte symbols."""
        if word.isascii() and word.isprintable():
            return word
        return word.encode().decode("latin-1").translate(self.of_byte)

    def parts(self, text: str) -> Iterator[int | list[str]]:
        """A text as ids of special tokens and lists of words."""
        for n, part in enumerate(self.at_special.split(text) if self.at_special else [text]):
            if n % 2:
                yield self.special[part]
                continue
            for stretch in _stretches(part):
                if self.is_plain(stretch):  # its white space ends words and is in none
                    words = _ASCII_PATTERN.findall(stretch.lower())
                    yield from (words[i : i + WORDS] for i in range(0, len(words), WORDS))
                    continue
                found = self.words(self.normalizer.normalize_str(stretch))
                while taken := list(islice(found, WORDS)):
                    yield taken

    def is_plain(self, text: str) -> bool:
        """Whether the short way for ASCII gives the words of a text."""
        plain = self.knows_ascii and len(text) <= STRETCH and text.isascii()
        return plain and (not self.other_ascii or self.other_ascii.isdisjoint(text))

    def learn(self, words: set[str]) -> None:
        """Find ids and decoded text of the words that are not remembered. Long words stay until
        the next ones are learnt."""
        for w in self.passing:
            del self.ids_of[w], self.text_of[w]
        if len(self.ids_of) > REMEMBERED:
            self.ids_of.clear()
            self.text_of.clear()
        new = list(words.difference(self.ids_of))
        ids, repaired = self.table.encoded([self.symbols(w) for w in new])
        self.speculated += len(new)
        self.repaired += repaired
        self.ids_of.update(zip(new, (array("I", i).tobytes() for i in ids)))
        self.text_of.update(zip(new, map(self.decode, ids)))
        self.passing = [w for w in new if len(w) > LONG]

    def digests(self, texts: list[str]) -> Iterator[tuple[int, str, str]]:
        """Of each text: number of ids, and digests of its ids and of its decoded text."""
        batch: list[tuple[int, list[int | list[str]]]] = []
        state = [[0, hashlib.sha256(), hashlib.sha256()] for _ in texts]
        held = 0
        for n, text in enumerate(texts):
            for part in self.parts(text):
                batch.append((n, part))
                held += len(part) if isinstance(part, list) else 1
                if held >= WORDS:
                    self._digest(batch, state)
                    batch, held = [], 0
        self._digest(batch, state)
        return ((count, ids.hexdigest(), text.hexdigest()) for count, ids, text in state)

    def _digest(self, batch: list, state: list) -> None:
        self.learn(set(chain.from_iterable(part for _, part in batch if isinstance(part, list))))
        ids_of, text_of = self.ids_of.__getitem__, self.text_of.__getitem__
        for n, part in batch:
            if isinstance(part, int):
                ids, text = array("I", [part]).tobytes(), self.strings[part]
            else:
                ids, text = b"".join(map(ids_of, part)), " ".join(map(text_of, part))
            if ids:
                state[n][2].update((" " + text if state[n][0] else text).encode())
                state[n][1].update(ids)
                state[n][0] += len(ids) // 4

    def encode(self, text: str) -> list[int]:
        ids = array("I")
        for part in self.parts(text):
            if isinstance(part, int):
                ids.append(part)
            else:
                self.learn(set(part))
                ids.frombytes(b"".join([self.ids_of[w] for w in part]))
        return ids.tolist()


def _byte_symbols() -> dict[int, str]:
    """Printable stand-ins of bytes in byte-level files: printable Latin-1 characters stand for
    themselves, all others for characters from U+0100 on, in order."""
    own = [c for c in range(256) if 33 <= c <= 126 or 161 <= c <= 172 or 174 <= c <= 255]
    others = [c for c in range(256) if c not in own]
    return {c: chr(c) for c in own} | {c: chr(256 + n) for n, c in enumerate(others)}


def _stretches(text: str) -> Iterator[str]:
    start = 0
    while len(text) - start > STRETCH and (cut := _CUT.search(text, start + STRETCH)):
        yield text[start : cut.start()]
        start = cut.start()
    yield text[start:]


@cache
def word_encoder(path: str) -> WordEncoder:
    """The encoder of a file, loaded once by a worker."""
    return WordEncoder(path)


def bpe_round_trip(docs: DataFrame, path: str | None = None) -> DataFrame:
    """`doc_id`, `n_tokens`, `ids_sha256`, `decoded_sha256` of every row of `docs`."""
    path = path or tokenizer_path(TOKENIZER)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = word_encoder(path)
        for batch in batches:
            for part in by_bytes(batch, "text"):
                found = list(encoder.digests([t or "" for t in part.column("text").to_pylist()]))
                columns = [list(c) for c in zip(*found)] or [[], [], []]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(columns[0], pa.int64()), *(pa.array(c, pa.string()) for c in columns[1:])],
                    names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
                )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
