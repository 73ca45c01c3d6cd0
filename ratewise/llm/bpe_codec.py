"""Byte-level BPE encoding and decoding with a local rank file.

Encoding uses the tiktoken library: the ranks come from a file on each worker,
long texts are pre-split at safe boundaries (``common.safe_segments``), and no
special token exists.  A very long run of blanks is one match of the pattern, which
the library's matcher can't hold; such a match is found here and given to the library as
one piece.  Decoding joins the raw bytes of the ids; those bytes
are the text exactly, also where a single id is no valid UTF-8.

Defined results: a null text encodes like an empty one (no ids); null ids
decode to no bytes; rows are kept one to one, with null or equal ids too;
columns other than those named are ignored."""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratewise.llm.common import kernel, safe_segments, text_groups
from ratewise.llm.token_counts import vocab_file

SEGMENT_CHARS = 1 << 16
GROUP_BYTES = 1 << 20
#: Blanks as the pattern's matcher knows them (Unicode White_Space), in runs too long for it.
_LONG_BLANKS = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{10000,}")


@lru_cache(maxsize=2)
def _codec(ranks_file: str):
    import public_tokenizers
    import tiktoken

    ranks = {}
    with open(vocab_file(ranks_file), "rb") as f:
        for line in f:
            token, rank = line.split()
            ranks[base64.b64decode(token)] = int(rank)
    return tiktoken.Encoding(ranks_file, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def _encode_text(enc, text: str) -> list[int]:
    ids: list[int] = []
    start = 0
    for run in _LONG_BLANKS.finditer(text) if len(text) >= 10_000 else ():
        # the last blank before other text isn't part of the run's match
        end = run.end() - (run.end() < len(text))
        ids += _encode_parts(enc, text[start:run.start()])
        ids += enc._core_bpe.encode_single_piece(text[run.start():end].encode())
        start = end
    return ids + _encode_parts(enc, text[start:]) if start else _encode_parts(enc, text)


def _encode_parts(enc, text: str) -> list[int]:
    if len(text) <= SEGMENT_CHARS:
        return enc.encode_ordinary(text)
    ids: list[int] = []
    for part in safe_segments(text, SEGMENT_CHARS):
        ids += enc.encode_ordinary(part)
    return ids


def _lists(values: list[list[int]]) -> pa.Array:
    ends = np.cumsum([0, *map(len, values)], dtype=np.int32)
    flat = np.fromiter((i for v in values for i in v), np.int32, int(ends[-1]))
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))


def encode(docs: DataFrame, ranks_file: str = "byte_bpe_50k.tiktoken", id_col: str = "doc_id",
           text_col: str = "text") -> DataFrame:
    """(doc_id, ids array<int>) of every row of ``docs``.  One scan, no shuffle."""
    kernel(docs)
    src = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = _codec(ranks_file)
        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                b = whole.slice(at, 512)
                ids = _lists([_encode_text(enc, t) for t in b.column("text").to_pylist()])
                yield pa.RecordBatch.from_arrays([b.column("doc_id"), ids], ["doc_id", "ids"])

    return src.mapInArrow(run, f"doc_id {src.schema['doc_id'].dataType.simpleString()}, ids array<int>")


def decode(encoded: DataFrame, ranks_file: str = "byte_bpe_50k.tiktoken", ids_col: str = "ids",
           keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The kept columns, the ids, and ``decoded``: the ids' raw bytes."""
    kernel(encoded)
    src = encoded.select(*keep, F.coalesce(F.col(ids_col), F.array().cast("array<int>")).alias("ids"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = _codec(ranks_file)
        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                b = whole.slice(at, 512)
                ids = b.column("ids").to_pylist()
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(map(enc.decode_bytes, ids), pa.binary())],
                                                 [*b.schema.names, "decoded"])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in src.schema.fields)
    return src.mapInArrow(run, f"{kinds}, decoded binary")


def encode_and_decode(docs: DataFrame, ranks_file: str = "byte_bpe_50k.tiktoken", id_col: str = "doc_id",
                      text_col: str = "text") -> DataFrame:
    """(doc_id, ids, decoded): ``decode(encode(docs))`` in one pass, so one worker a task holds
    the ranks and only a few hundred rows of ids at a time."""
    kernel(docs)
    src = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = _codec(ranks_file)
        for b in text_groups(batches, "text", GROUP_BYTES):
            ids = [_encode_text(enc, t) for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), _lists(ids), pa.array(map(enc.decode_bytes, ids), pa.binary())],
                                             ["doc_id", "ids", "decoded"])

    return src.mapInArrow(run, f"doc_id {src.schema['doc_id'].dataType.simpleString()}, ids array<int>, decoded binary")


def round_trip(docs: DataFrame, ranks_file: str = "byte_bpe_50k.tiktoken", id_col: str = "doc_id",
               text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): digests of the ids
    (decimal, joined by one space) and of the bytes they decode to."""
    both = encode_and_decode(docs, ranks_file, id_col, text_col)
    return both.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                       F.sha2(F.array_join(F.col("ids").cast("array<string>"), " ").cast("binary"), 256).alias("ids_sha256"),
                       F.sha2(F.col("decoded"), 256).alias("decoded_sha256"))
