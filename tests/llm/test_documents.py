"""Every operator on odd rows, on no rows, and against plain Python."""

import hashlib
import random
import re
import time
import zlib
from array import array
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from llm.cases import no_documents, odd_documents, odd_rows, tuples
from orderlake.llm.license_scan import (
    COVERAGE,
    TEMPLATES,
    Match,
    TemplateIndex,
    align,
    all_templates,
    license_matches,
    longest_apart,
    within,
    words_of,
)
from orderlake.llm.merkle import edit_region, fingerprints, leaf_digests, root
from orderlake.llm.minhash import near_duplicates, one_of_each
from orderlake.llm.mixing import mix, mixed_documents, targets
from orderlake.llm.packing import best_fit, complete_bins, lower_bound, pack
from orderlake.llm.secret_scan import RULES, Rule, scan_unseen, secret_report, without_secrets
from orderlake.llm.suffix_dedup import common_prefix, sorted_with_lcp, without_repeats
from orderlake.llm.tokens import TextEncoder, stretches, token_counts, tokenizer_path

TEXTS = [(r[0], r[1] or "") for r in odd_rows()]


def plain_ids(text):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer_path()).encode(text, add_special_tokens=False).ids


# --- tokens and packing --------------------------------------------------------------------


def test_token_counts(spark):
    want = sorted(
        ((i, len(t.encode()), len(plain_ids(t)), len(plain_ids(t)) > 1024) for i, t in TEXTS), key=repr
    )
    assert tuples(token_counts(odd_documents(spark))) == want
    assert token_counts(no_documents(spark)).collect() == []


def test_encoder_is_the_library():
    r, encoder = random.Random(1), TextEncoder(tokenizer_path())
    pieces = [" ", "  ", "\n", "\x0b", "\x1c", "\x85", "\xa0", "　", "a", "B1", "!", "'s", "<|endoftext|>", "é", "中", "\x00"]
    for _ in range(500):
        text = "".join(r.choice(pieces) for _ in range(r.randint(0, 12)))
        assert encoder.ids(text) == plain_ids(text), repr(text)
    text = "".join(r.choice(pieces) for _ in range(20_000))
    parts = list(stretches(text, 500))
    assert "".join(parts) == text and len(parts) > 10
    assert [i for p in parts for i in plain_ids(p)] == plain_ids(text)


def test_pack(spark):
    rows = pack(odd_documents(spark)).collect()
    want = Counter()
    for doc_id, text in TEXTS:
        ids = [*plain_ids(text), 2]
        start, stop, piece = 0, len(ids) % 1024 or 1024, 0
        while start < len(ids):
            crc = zlib.crc32(array("I", ids[start:stop]).tobytes())
            want[(doc_id, piece, start, stop - start, crc)] += 1
            start, stop, piece = stop, stop + 1024, piece + 1
    assert Counter(tuple(r)[:5] for r in rows) == want
    places = {}
    for r in rows:
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for found in places.values():
        at = 0
        for offset, length in sorted(found):
            assert offset == at
            at += length
        assert at <= 1024
    assert pack(no_documents(spark)).collect() == []


@pytest.mark.parametrize("seed", range(6))
def test_complete_bins(seed):
    r = random.Random(seed)
    counts = Counter(r.randint(150, 700) for _ in range(60))
    kinds = complete_bins(counts, 1024)
    placed = Counter()
    for lengths, times in kinds:
        assert sum(lengths) <= 1024
        for length in lengths:
            placed[length] += times
    n = sum(t for _, t in kinds)
    assert placed == counts
    assert lower_bound(counts, 1024) <= n <= sum(t for _, t in best_fit(counts, 1024))


def test_complete_bins_beats_best_fit():
    counts = {600: 2, 424: 1, 400: 1, 224: 1, 200: 2}  # best fit wastes where completion does not
    assert sum(t for _, t in complete_bins(counts, 1024)) == 3


# --- secrets -------------------------------------------------------------------------------

BASE = {
    "assign": (re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.I | re.A), 2, 6),
    "access": (re.compile(r"(AKIA[A-Z0-9]+)"), 1, 20),
    "hex": (re.compile(r"([0-9a-f]+)"), 1, 24),
}


def plain_spans(text):
    found = []
    for k, (kind, (pattern, group, least)) in enumerate(BASE.items()):
        found += [(m.start(), k, m.end(), kind) for m in pattern.finditer(text) if len(m[group]) >= least]
    return sorted(found)


def test_secret_report(spark):
    want = []
    for doc_id, text in TEXTS:
        found = plain_spans(text)
        spans = ",".join(f"{kind}:{a}:{b}" for a, _, b, kind in found)
        n = Counter(kind for *_, kind in found)
        want.append((doc_id, n["assign"], n["access"], n["hex"], hashlib.sha256(spans.encode()).hexdigest(), spans))
    assert any(w[1] for w in want) and any(w[2] for w in want) and any(w[3] for w in want)
    assert tuples(secret_report(odd_documents(spark))) == sorted(want, key=repr)
    assert secret_report(no_documents(spark)).collect() == []


def test_ledger_scans_only_what_is_new(spark, tmp_path):
    ledger = str(tmp_path / "ledger")
    docs = odd_documents(spark).where("doc_id < 8")
    first = scan_unseen(docs, ledger).count()
    assert first == 3 * docs.select(F.coalesce("text", F.lit(""))).distinct().count()
    assert scan_unseen(docs, ledger).count() == first
    scan_unseen(docs.union(odd_documents(spark).where("doc_id = 8")), ledger)
    assert spark.read.parquet(ledger).count() == first + 3
    changed = (Rule("assign", 2, RULES[0].pattern, 2, 8, RULES[0].hint), *RULES[1:])
    assert scan_unseen(docs, ledger, changed).where("version = 2").count() == first // 3
    report = secret_report(docs, ledger, changed)
    assert report.count() == docs.count()
    assert tuples(secret_report(docs, ledger)) == tuples(secret_report(docs))


def test_a_pair_that_the_ledger_holds_twice_counts_once(spark, tmp_path):
    """Two writers that scan side by side both append; so does a job that is run again."""
    ledger, docs = str(tmp_path / "ledger"), odd_documents(spark)
    once = tuples(secret_report(docs, ledger))
    spark.read.parquet(ledger).write.mode("append").parquet(str(tmp_path / "twice"))
    spark.read.parquet(ledger).write.mode("append").parquet(str(tmp_path / "twice"))
    assert tuples(secret_report(docs, str(tmp_path / "twice"))) == once


def test_without_secrets(spark):
    docs = odd_documents(spark)
    out = without_secrets(docs)
    assert out.dtypes == docs.dtypes
    want = []
    for r in odd_rows():
        text, at, masked = r[1], 0, ""
        if text is not None and plain_spans(text):
            for start, _, stop, _ in plain_spans(text):
                if start >= at:
                    masked += text[at:start] + "[SECRET]"
                at = max(at, stop)
            text = masked + text[at:]
            r = (r[0], text, *r[2:4], len(text), *r[5:])
        want.append(r)
    assert tuples(out) == sorted(want, key=repr)
    assert without_secrets(no_documents(spark)).collect() == []


# --- near-duplicates -----------------------------------------------------------------------


def bag(text):
    words = re.findall(r"\w+", text.lower())
    n = min(5, len(words))
    return Counter(tuple(words[i : i + n]) for i in range(len(words) - n + 1)) if n else Counter()


def plain_classes(texts):
    bags = [bag(t) for t in texts]
    parent = list(range(len(texts)))

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(bags):
        for j, b in enumerate(bags[:i]):
            if (a and b and sum((a & b).values()) >= 0.8 * sum((a | b).values())) or (texts[i].strip() and texts[i] == texts[j]):
                parent[max(top(i), top(j))] = min(top(i), top(j))
    return [top(i) for i in range(len(texts))]


def test_near_duplicates(spark):
    top = plain_classes([t for _, t in TEXTS])
    want = []
    for k, (doc_id, _) in enumerate(TEXTS):
        members = [TEXTS[m][0] for m in range(len(TEXTS)) if top[m] == top[k]]
        ids = [m for m in members if m is not None]
        want.append((doc_id, min(ids, default=None), len(members)))
    assert tuples(near_duplicates(odd_documents(spark))) == sorted(want, key=repr)
    assert near_duplicates(no_documents(spark)).collect() == []


def test_near_duplicates_of_test_data(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = docs.orderBy("doc_id").collect()
    top = plain_classes([r.text for r in rows])
    assert len(set(top)) < len(rows)
    got = {r.doc_id: r.class_id for r in near_duplicates(docs).collect()}
    assert got == {r.doc_id: rows[t].doc_id for r, t in zip(rows, top)}


def test_one_of_each(spark):
    docs = odd_documents(spark)
    out = one_of_each(docs)
    assert out.dtypes == docs.dtypes
    top = plain_classes([t for _, t in TEXTS])
    want = []
    for k in sorted(set(top)):
        members = [r for r, t in zip(odd_rows(), top) if t == k]
        want.append(min(members, key=lambda r: (r[0] is None, r[0] or 0)))
    assert tuples(out) == sorted(want, key=repr)
    assert one_of_each(no_documents(spark)).collect() == []


def test_hubs_lose_no_link(spark):
    """A chain in one group: neighbours are similar, the ends are not, and no hub is near to all."""
    base = [f"w{i}" for i in range(120)]
    texts = []
    for step in range(8):
        words = list(base)
        words[: 4 * step] = [f"x{i}" for i in range(4 * step)]
        texts.append(" ".join(words))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert plain_classes(texts) == [0] * 8
    assert {r.class_id for r in near_duplicates(docs).collect()} == {0}


# --- mixing --------------------------------------------------------------------------------


def test_targets():
    assert targets([100, 100, 100], [3, 1, 2]) == [200, 250 / 3, 500 / 3]
    assert targets([], []) == [] and targets([0, 0], [3, 1]) == [0, 0]
    got = targets([10, 1000, 1000], [3, 1, 2])
    assert got[0] == 20 and abs(sum(got) - 3015) < 1e-6


def test_mix(spark):
    docs = odd_documents(spark)
    rows = mix(docs).collect()
    count = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    assert Counter((r.doc_id, r["size"]) for r in rows) == Counter((i, count(t)) for i, t in TEXTS)
    assert all(0 <= r.taken <= 2 * r["size"] for r in rows)
    sizes = Counter()
    for r in odd_rows():
        sizes[r[3]] += count(r[1])
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    aims = dict(zip(names, targets([sizes[n] for n in names], [(3, 1, 2)[i % 3] for i in range(len(names))])))
    assert {(r.source_size, r.target) for r in rows} == {(sizes[n], aims[n]) for n in names}
    source_of = {(i, count(t)): s for i, t, s in ((r[0], r[1], r[3]) for r in odd_rows())}
    for name in names:
        taken = sum(r.taken for r in rows if source_of[(r.doc_id, r["size"])] == name)
        assert abs(taken - aims[name]) <= max(0.05 * aims[name], 64), (name, aims[name], taken)
    assert tuples(mix(docs.repartition(7))) == tuples(mix(docs))
    assert mix(no_documents(spark)).collect() == []


def test_mixed_documents_hold_what_is_taken(spark):
    docs = odd_documents(spark)
    out = mixed_documents(docs)
    assert out.dtypes == docs.dtypes
    words = lambda t: re.findall(r"[^\x20\x09-\x0D]+", t or "")
    taken = sum(r.taken for r in mix(docs).collect())
    rows = out.collect()
    assert sum(len(words(r.text)) for r in rows) == taken
    for r in rows:
        assert r.n_chars == len(r.text)
        have = Counter(w for i, t in TEXTS if i == r.doc_id for w in words(t))
        assert not Counter(words(r.text)) - have
    assert mixed_documents(no_documents(spark)).collect() == []


# --- repeated strings ----------------------------------------------------------------------


def plain_removal(texts, span=200):
    starts = Counter(t[i : i + span] for t in texts for i in range(len(t) - span + 1))
    out = []
    for t in texts:
        gone = bytearray(len(t))
        for i in range(len(t) - span + 1):
            if starts[t[i : i + span]] > 1:
                gone[i : i + span] = b"\1" * span
        kept = bytes(c for c, g in zip(t, gone) if not g)
        runs = len(re.findall(b"\1+", bytes(gone)))
        out.append((len(t), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return out


def test_without_repeats(spark):
    want = [(i, *r) for (i, _), r in zip(TEXTS, plain_removal([t.encode() for _, t in TEXTS]))]
    assert any(w[2] for w in want)
    assert tuples(without_repeats(odd_documents(spark))) == sorted(want, key=repr)
    assert without_repeats(no_documents(spark)).collect() == []


@pytest.mark.parametrize("together", [1_000, 2])
def test_without_repeats_of_shared_passages(spark, monkeypatch, together):
    """Passages of all lengths around the limit, cut from and put into texts; hot anchors too."""
    import orderlake.llm.suffix_dedup as suffix_dedup

    monkeypatch.setattr(suffix_dedup, "SORTED_TOGETHER", together)
    r = random.Random(4)
    word = lambda: "".join(r.choice("abcdefé") for _ in range(r.randint(1, 7)))
    text = lambda n: " ".join(word() for _ in range(n))
    passage = text(200)
    texts = []
    for _ in range(40):
        a = r.randint(0, len(passage) - 1)
        part = passage[a : a + r.choice([100, 190, 198, 199, 200, 201, 260, 500, 900])]
        texts.append(text(r.randint(0, 60)) + part + text(r.randint(0, 60)) + r.choice(["", part[:220]]))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    want = [(i, *w) for i, w in enumerate(plain_removal([t.encode() for t in texts]))]
    assert sum(bool(w[2]) for w in want) > 10
    assert tuples(without_repeats(docs)) == sorted(want, key=repr)


def test_large_groups_are_parted_and_sorted(spark, monkeypatch):
    """A passage between ever other words: its edges' anchors have as many surroundings as texts."""
    import orderlake.llm.suffix_dedup as suffix_dedup

    monkeypatch.setattr(suffix_dedup, "SORTED_TOGETHER", 5)
    r = random.Random(8)
    some = lambda n: "".join(r.choice("abcdef ") for _ in range(n))
    passage = some(260)
    texts = [some(r.randint(0, 250)) + passage[r.choice([0, 0, 3, 40]) : r.choice([260, 260, 250, 203])] + some(r.randint(0, 250)) for _ in range(60)]
    texts += ["ab" * 300, "ab" * 180 + "c" + "ab" * 150, passage[:210], passage[50:260], texts[0], texts[0]]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    want = [(i, *w) for i, w in enumerate(plain_removal([t.encode() for t in texts]))]
    assert tuples(without_repeats(docs)) == sorted(want, key=repr)


def test_deep_shallow_sort():
    r = random.Random(2)
    for letters, longest in ((b"ab", 60), (b"abcdef", 90), (b"a", 70)):
        strings = [bytes(r.choice(letters) for _ in range(r.randint(0, longest))) for _ in range(150)]
        strings += [b"x" * 50 + s[:20] for s in strings]
        order, lcp = sorted_with_lcp(strings)
        assert [strings[i] for i in order] == sorted(strings)
        assert all(lcp[k] == common_prefix(strings[order[k - 1]], strings[order[k]]) for k in range(1, len(order)))


# --- fingerprints --------------------------------------------------------------------------


def whole_leaves(text):
    return [hashlib.md5(x.encode()).hexdigest() for x in re.findall(r"[^\n.!?]{0,95}[.!?\n]+|[^\n.!?]{1,96}", text)]


def plain_leaves(text):
    return [x[:8] for x in whole_leaves(text)]


def plain_fingerprint(text):
    digests = "".join(whole_leaves(text))
    runs = re.findall(r"(?:[2-9a-f][0-9a-f]{31})*[01][0-9a-f]{31}|(?:[2-9a-f][0-9a-f]{31})+", digests)
    sections = "".join(hashlib.md5(x.encode()).hexdigest() for x in runs)
    return hashlib.md5(sections.encode()).hexdigest() + ":" + "".join(plain_leaves(text))


def plain_edit(a, b):
    a, b, start, end = whole_leaves(a), whole_leaves(b), 0, 0
    while start < min(len(a), len(b)) and a[start] == b[start]:
        start += 1
    while end < min(len(a), len(b)) - start and a[-1 - end] == b[-1 - end]:
        end += 1
    return start, len(a) - start - end, len(b) - start - end


def dice(a, b):
    a, b = set(plain_leaves(a)), set(plain_leaves(b))
    return 2 * len(a & b) / (len(a) + len(b)) if a or b else 1.0


def test_fingerprints(spark):
    md5 = lambda t: hashlib.md5(t.encode()).hexdigest()
    by_text = sorted(set(TEXTS), key=lambda x: md5(x[1]), reverse=True)
    ring = sorted(by_text, key=lambda x: (x[0] is None, -(x[0] or 0)))
    after = dict(zip(ring, [*ring[1:], ring[0]]))
    want = []
    for doc_id, text in TEXTS:
        other, k = after[(doc_id, text)][1], len(text) // 3
        edited = text[: len(text) - k] + other[:k]
        want.append(
            (doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest(), plain_fingerprint(text),
             plain_fingerprint(edited), dice(text, edited), dice(text, other), *plain_edit(text, edited))
        )
    assert tuples(fingerprints(odd_documents(spark))) == sorted(want, key=repr)
    assert fingerprints(no_documents(spark)).collect() == []
    alone = fingerprints(odd_documents(spark).where("doc_id = 2")).collect()
    assert alone[0].near_next == 1.0


def test_edits_are_located(spark):
    """Changed, removed, repeated and moved leaves, and texts that are not or fully different."""
    r = random.Random(12)
    base = [f"Sentence {r.randint(0, 10**9)}." for _ in range(60)]
    pairs = [("", ""), ("", "a."), ("a.b.", "a.b."), ("a.b.", "a.b.b."), ("a.b.", "a."), ("b.", "a.b."), ("a.a.a.", "a.a."), ("x.", "y.z.")]
    for _ in range(40):
        b, i, j = base[:], r.randrange(60), r.randrange(60)
        kind = r.randrange(4)
        if kind == 0:
            b[i] = "New."
        elif kind == 1:
            del b[i : i + r.randint(1, 9)]
        elif kind == 2:
            b.insert(i, b[i])
        else:
            b.insert(j, b.pop(i))
        pairs.append(("".join(base), "".join(b)))
    df = spark.createDataFrame(pairs, "a string, b string")
    a, b = leaf_digests(F.col("a")), leaf_digests(F.col("b"))
    got = df.select("a", "b", (root(a) == root(b)).alias("same"), edit_region(a, b).alias("e")).collect()
    assert [(x.same, *x.e) for x in got] == [(x.a == x.b, *plain_edit(x.a, x.b)) for x in got]


# --- licenses ------------------------------------------------------------------------------


def local_alignment(text, words):
    """Best local alignment without a band: matched words (match +2, other -1)."""
    best, above = (0, 0), [(0, 0)] * (len(words) + 1)
    for a in text:
        row = [(0, 0)]
        for j, b in enumerate(words):
            diagonal = (above[j][0] + 2, above[j][1] + 1) if a == b else (above[j][0] - 1, above[j][1])
            options = [diagonal, (above[j + 1][0] - 1, above[j + 1][1]), (row[-1][0] - 1, row[-1][1])]
            top = max(options, key=lambda o: o[0])
            row.append(top if top[0] > 0 else (0, 0))
            best = max(best, row[-1], key=lambda o: o[0])
        above = row
    return best[1]


def test_license_matches(spark):
    r, index = random.Random(5), TemplateIndex(TEMPLATES)
    for name, template in TEMPLATES.items():
        words = template.split(" ")
        for k in range(0, len(words), max(3, len(words) // 4)):
            noisy = words[:k] + ["ghbn"] * (len(words) > 20) + words[k:]
            text = "Abrt kio. İx " + " ".join(noisy) + " olp thn."
            found = [m for m in index.scan(text) if m.template == name]
            assert found and found[0].words == local_alignment(words_of(text), words_of(template))
            assert text[found[0].start : found[0].stop].split(" ")[0].strip("(;,.") == words[0]
    assert index.scan(" ".join(r.choice(["of", "the", "license", "zz"]) for _ in range(300))) == []
    got = license_matches(odd_documents(spark)).collect()
    assert [(m.doc_id, m.template, m.coverage, m.span_start, m.span_stop) for m in got] == [(14, "MIT", 1.0, 0, 30)]
    assert license_matches(no_documents(spark)).collect() == []


def unbanded(index, text):
    """All matches by alignments over every word of the text and of each template."""
    starts, ends, hashes, _ = index.hasher.of(text)
    numbers, found = index.numbers(hashes), []
    for t in np.flatnonzero(index.possible(numbers)).tolist():
        words, left = np.array(index.words[t], np.int64), [(0, len(numbers))]
        while left:
            a, b = left.pop()
            if not index._possible(t, numbers[a:b]):
                continue
            whole = np.zeros(b - a, np.int64), np.full(b - a, len(words))
            n, x, y = align(numbers[a:b], words, *whole)
            if n >= COVERAGE * len(words):
                if all(within(p, numbers[a + x : a + y + 1].tolist()) for p in index.required[t]):
                    found.append(Match(index.names[t], n, len(words), int(starts[a + x]), int(ends[a + y])))
                left += [(a, a + x), (a + y + 1, b)]
    return longest_apart(found)


def test_license_matches_of_whole_texts(spark, sf_dir):
    """Candidates and bands lose nothing against every template without a band."""
    index = TemplateIndex(all_templates())
    texts = [r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect() if r.text]
    r, some = random.Random(6), list(all_templates().values())
    for _ in range(12):  # texts with changed words, and several in a row
        words = " \n".join(r.sample(some, 3)).split(" ")[:1500]
        texts.append(" ".join(w if r.random() > 0.04 else r.choice(["", "olp kio", "thn"]) for w in words))
    assert sum(bool(index.scan(t)) for t in texts) > 8
    for text in texts:
        assert index.scan(text) == unbanded(index, text)


def test_long_texts_and_other_shares():
    index, text = TemplateIndex(all_templates()), all_templates()["GPL-3-text"]
    began = time.time()
    assert [m.template for m in index.scan(f"{text}\n" * 3)] == ["GPL-3-text"] * 3
    assert time.time() - began < 5
    half = " ".join(text.split()[: len(text.split()) // 2])
    assert index.scan(half) == []
    found = TemplateIndex(all_templates(), coverage=0.45).scan(half)
    assert [m.template for m in found] == ["GPL-3-text"] and 0.45 < found[0].words / found[0].of < 0.55


def test_license_repeats():
    index = TemplateIndex(TEMPLATES)
    for name in ("MIT", "Apache-2.0", "CC-BY-NC-4.0", "GPL-3.0", "ISC-text"):
        words = words_of(TEMPLATES[name])
        for copies in (2, 3, 40):
            for between in ([], ["olp"], ["olp"] * 5, ["olp"] * 12, ["olp"] * 13):
                text = " ".join((words + between) * copies)
                got = [(m.template, m.words, m.start) for m in index.scan(text)]
                step = len(" ".join(words + between)) + 1
                assert got == [(name, local_alignment(words, words), i * step) for i in range(copies)]
    text = "Released under the MIT License. Licensed under CC BY-NC 4.0. Released under the old MIT License"
    assert [m.template for m in index.scan(text)] == ["MIT", "CC-BY-NC-4.0", "MIT"]


def test_license_variants():
    index, short = TemplateIndex(all_templates()), TemplateIndex({n: TEMPLATES[n] for n in list(TEMPLATES)[:10]})
    gpl = "This work is licensed under the GNU {}General Public License, version {}"
    for text, name in (
        ("Licensed under CC BY-SA 4.0", "CC-BY-SA-4.0"), ("Licensed under CC BY 4.0", "CC-BY-4.0"),
        ("Licensed under CC BY-NC-SA 4.0", "CC-BY-NC-SA-4.0"), ("Licensed under CC BY-NC 4.0", "CC-BY-NC-4.0"),
        ("Creative Commons Attribution-ShareAlike 4.0 International", "CC-BY-SA-4.0-title"),
        (gpl.format("", 2), "GPL-2.0"), (gpl.format("", 3), "GPL-3.0"), (gpl.format("Lesser ", 3), "LGPL-3.0"),
        (gpl.format("Affero ", 3), "AGPL-3.0"), (TEMPLATES["GPL-notice"], "GPL-notice"),
        (TEMPLATES["GPL-notice"].replace("version 3", "version 2"), "GPL-2.0-notice"),
    ):
        assert [m.template for m in index.scan(f"Olp thn. {text}. Kio.")] == [name]
        # Without a template of its own a near miss has no name, not a wrong one.
        assert {m.template for m in short.scan(f"Olp thn. {text}. Kio.")} <= {name}
    for name, text in all_templates().items():
        if name not in TEMPLATES:
            found = index.scan(f"Olp thn.\n{text}\nKio. Released under the MIT License.")
            assert [m.template for m in found] == [name, "MIT"] and found[0].words == found[0].of
    affero = all_templates()["GPL-3-text"].replace("GNU General", "GNU Affero General")
    assert "GPL-3-text" not in {m.template for m in index.scan(affero)}
