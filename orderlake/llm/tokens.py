"""Token counts and ids of whole texts by a public byte-level BPE file.

Texts go to the encoder in slices of a record batch that hold about equally many bytes. A text
longer than such a slice is encoded in stretches that end where the pre-tokenizer always cuts:
between a character that is not white space and a space.

The `.json` file defines the result. Where the same vocabulary lies beside it as ranks, the
faster library for ranks encodes (the tests compare both); texts that hold a special string or
a very long run of white space go to the library for the `.json` file itself.

Rows: one per input row, also for repeated rows and repeated ids. A NULL text counts as empty:
no bytes and no tokens. Other columns, whatever their names, are not read. An empty table
gives an empty result. A text without any space is encoded in one piece, whatever its length.
"""

from __future__ import annotations

import base64
import os
import re
from array import array
from collections.abc import Iterator
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TOKENIZER = "byte_bpe_50k.json"
BATCH_BYTES = 1 << 20  # bytes of text handed to the encoder at a time

# The ranks library gives up on runs of white space near a million characters.
_LONG_SPACE = re.compile(r"\s{9999}")


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class TextEncoder:
    """Token ids of texts, without begin, end or added special tokens."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.plain = Tokenizer.from_file(path)
        self.plain.no_truncation()
        self.plain.no_padding()
        special = [t.content for t in self.plain.get_added_tokens_decoder().values()]
        self.special = re.compile("|".join(map(re.escape, special))) if special else None
        self.by_ranks = self._ranks(path.removesuffix(".json") + ".tiktoken")

    @staticmethod
    def _ranks(path: str):
        if not os.path.exists(path):
            return None
        import public_tokenizers
        import tiktoken

        with open(path, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        encoding = tiktoken.Encoding(
            "ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
        )
        return encoding.encode_ordinary

    def ids(self, text: str) -> list[int]:
        ids: list[int] = []
        for part in stretches(text):
            usual = not (self.special and self.special.search(part)) and not _LONG_SPACE.search(part)
            if usual and self.by_ranks:
                ids += self.by_ranks(part)
            else:
                ids += self.plain.encode(part, add_special_tokens=False).ids
        return ids


@cache
def text_encoder(path: str) -> TextEncoder:
    """The encoder of a file, loaded once by a worker."""
    return TextEncoder(path)


def stretches(text: str, size: int = BATCH_BYTES) -> Iterator[str]:
    """`text` in parts of about `size` characters, each but the first starting at a safe space."""
    start = 0
    while len(text) - start > size:
        end = text.find(" ", start + size)
        while end > 0 and text[end - 1].isspace():
            end = text.find(" ", end + 1)
        if end < 0:
            break
        yield text[start:end]
        start = end
    yield text[start:]


def by_bytes(batch: pa.RecordBatch, column: str, size: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of a record batch with about equally many bytes in `column`."""
    import numpy as np
    import pyarrow.compute as pc

    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False))
    start = 0
    while start < batch.num_rows:
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + size, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


def little_endian(ids: list[int]) -> bytes:
    """Ids as unsigned 32-bit little-endian numbers, the platform's own order on all of Spark's."""
    return array("I", ids).tobytes()


def token_counts(docs: DataFrame, path: str | None = None, limit: int = 1024) -> DataFrame:
    """`doc_id`, `n_bytes`, `n_tokens`, `over_limit` of every row of `docs`."""
    path = path or tokenizer_path()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = text_encoder(path)
        for batch in batches:
            for part in by_bytes(batch, "text"):
                counts = [len(encoder.ids(t)) if t else 0 for t in part.column("text").to_pylist()]
                columns = [part.column("doc_id"), part.column("n_bytes"), pa.array(counts, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_bytes", "n_tokens"])

    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("text").cast("string").alias("text"),
        F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"),
    )
    counted = rows.mapInArrow(count, "doc_id long, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
