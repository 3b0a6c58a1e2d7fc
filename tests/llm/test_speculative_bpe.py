"""Encoding by speculation against the library that defines the result."""

import hashlib
import random
from array import array

import pytest

from orderlake.llm.speculative_bpe import TOKENIZER, WordEncoder, bpe_round_trip
from orderlake.llm.tokens import tokenizer_path
from llm.cases import no_documents, odd_documents, odd_rows, prose, tuples


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_path(TOKENIZER))
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


@pytest.fixture(scope="module")
def encoder():
    return WordEncoder(tokenizer_path(TOKENIZER))


def by_library(library, text):
    ids = library.encode(text or "", add_special_tokens=False).ids
    decoded = library.decode(ids, skip_special_tokens=False)
    return len(ids), hashlib.sha256(array("I", ids).tobytes()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()


def test_odd_documents(spark, library):
    expected = sorted(((r[0], *by_library(library, r[1])) for r in odd_rows()), key=repr)
    assert tuples(bpe_round_trip(odd_documents(spark))) == expected


def test_no_documents(spark):
    assert bpe_round_trip(no_documents(spark)).collect() == []


def test_whole_table(spark, sf_dir, library):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    expected = sorted(((r.doc_id, *by_library(library, r.text)) for r in docs.collect()), key=repr)
    assert tuples(bpe_round_trip(docs)) == expected


def test_random_texts(library, encoder):
    r = random.Random(7)
    pieces = list("aabbceinrst' '!.?0129éÉßΣİǅ中字\n\t　²½ŀ😀ⅷ\x00́") + ["'s", "'re", "<|endoftext|>", "<|start", "ing", "the"]
    for _ in range(4000):
        text = "".join(r.choice(pieces) for _ in range(r.randint(0, 30)))
        ids = library.encode(text, add_special_tokens=False).ids
        assert encoder.encode(text) == ids, text
        assert encoder.decode(ids) == library.decode(ids, skip_special_tokens=False), text


def test_speculation_holds_where_it_is_trusted(encoder):
    """Proposals that pass are what merging yields; short and long words merge alike."""
    r = random.Random(3)
    words = ["".join(r.choice("aeinrsthl") for _ in range(r.randint(1, 60))) for _ in range(3000)]
    found, repaired = encoder.table.encoded(words)
    assert 0 < repaired < len(words)
    assert found == [encoder.table.merged(w) for w in words]


@pytest.mark.parametrize("text", ["thein" * 60_000, "中文" * 60_000, "a1!" * 500_000, prose(5, 300_000), "x\n" * 900_000])
def test_long_texts(library, encoder, text):
    assert next(encoder.digests([text])) == by_library(library, text)


def test_short_way_for_ascii(library, encoder):
    """Every ASCII character beside letters, digits, marks and white space, without the normaliser."""
    assert encoder.knows_ascii
    r = random.Random(11)
    pieces = [chr(i) for i in range(128)] + ["I'll ", "we've", "'S", "\r\n\t", "The", "MERGED", "42"]
    for _ in range(3000):
        text = "".join(r.choice(pieces) for _ in range(r.randint(0, 30)))
        if encoder.is_plain(text):
            assert encoder.encode(text) == library.encode(text, add_special_tokens=False).ids, text
    assert encoder.is_plain("It's plain.") and not encoder.is_plain("naïve")
