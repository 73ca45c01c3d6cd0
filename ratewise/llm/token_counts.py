"""Token counts of whole texts under a public vocabulary (lengths only).

Arrow functions encode texts in batches balanced by bytes and send back one
number per text.  Texts of a byte-level vocabulary are cut at every safe place
(see ``common.safe_pieces``), so one call of the library encodes each distinct
piece of a batch once, however often it repeats, and no text is ever too long.

Defined results: a null text counts as empty (0 bytes, 0 tokens); rows with
equal or null ids are kept, one row out for each row in; other columns of the
input are ignored; an empty table gives an empty result."""

from __future__ import annotations

import json
import os
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratewise.llm.common import by_bytes, kernel, safe_pieces, safe_segments

BATCH_CHARS = 1 << 20
KNOWN_PIECES = 300_000
KNOWN_LENGTH = 64


def vocab_file(vocab: str) -> str:
    """A path as it is; a bare file name is one of the public vocabularies,
    found on the machine that asks."""
    if os.path.isabs(vocab):
        return vocab
    import public_tokenizers
    return public_tokenizers.path(vocab)


class _Library:
    """Counts tokens as the library of a vocabulary file does."""

    def __init__(self, vocab: str):
        path = vocab_file(vocab)
        self.known: dict[str, int] = {}
        if path.endswith(".model"):
            import sentencepiece
            sp = sentencepiece.SentencePieceProcessor(model_file=path)
            self.lengths = lambda texts: list(map(len, sp.encode(texts, num_threads=1)))
            self.cut = False
            return
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        from tokenizers import Tokenizer
        tok = Tokenizer.from_file(path)
        tok.no_truncation()
        tok.no_padding()
        self.lengths = lambda texts: list(map(len, tok.encode_batch_fast(texts, add_special_tokens=False)))
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        pre = spec.get("pre_tokenizer") or {}
        self.cut = (pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space")
                    and spec.get("normalizer") is None and spec.get("post_processor") is None
                    and not any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec["added_tokens"]))

    def count(self, texts: list[str]) -> list[int]:
        if not self.cut:
            return [n for run in by_bytes(texts, BATCH_CHARS) for n in self.lengths(run)]
        out = []
        for run in by_bytes(texts, BATCH_CHARS):
            out.extend(self._run(run) if len(run) > 1 else [sum(self._run(list(safe_segments(run[0], BATCH_CHARS))))])
        return out

    def _run(self, texts: list[str]) -> list[int]:
        known, pieces = self.known, [safe_pieces(t) for t in texts]
        new = list(set().union(*pieces).difference(known))
        now = dict(zip(new, self.lengths(new)))
        if len(known) + len(now) > KNOWN_PIECES:
            known.clear()
            now.update(zip(more := list(set().union(*pieces).difference(now)), self.lengths(more)))
        lookup = known | now if len(known) < len(now) else None
        if lookup is None:
            known.update(now)
            lookup = known
        counts = [sum(map(lookup.__getitem__, p)) for p in pieces]
        if lookup is not known:
            known.update(now)
        for w in new:
            if len(w) > KNOWN_LENGTH:
                del known[w]
        return counts


@lru_cache(maxsize=2)
def _library(vocab: str) -> _Library:
    return _Library(vocab)


def token_counts(docs: DataFrame, vocab: str = "byte_bpe_50k.json", limit: int = 1024,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of every row of ``docs``.

    ``vocab`` is a ``.json`` (tokenizers) or ``.model`` (sentencepiece) file:
    a name among the public vocabularies or an absolute path on every worker.
    No begin, end or added special tokens; special strings inside a text are
    handled as the library does by default; nothing is cut off or padded.
    One scan, no shuffle."""
    kernel(docs)
    src = docs.select(F.col(id_col).alias("doc_id"), F.octet_length(F.coalesce(F.col(text_col), F.lit(""))).cast("long").alias("n_bytes"),
                      F.coalesce(F.col(text_col), F.lit("")).alias("text"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lib = _library(vocab)
        for b in batches:
            n = lib.count(b.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("n_bytes"), pa.array(n, pa.int64())],
                                             ["doc_id", "n_bytes", "n_tokens"])

    kind = src.schema["doc_id"].dataType.simpleString()
    return (src.mapInArrow(count, f"doc_id {kind}, n_bytes long, n_tokens long")
               .withColumn("over_limit", F.col("n_tokens") > limit))
