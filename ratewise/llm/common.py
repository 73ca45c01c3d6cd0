"""Helpers shared by the training-data operators.

Text conventions, the same in all of them unless a docstring says otherwise:
a null text is an empty text; words are ``[^\\x20\\x09-\\x0D]+``; lower-casing
touches A-Z only.  In Python that is ``text.encode().lower().split()``
(``bytes.split`` separates exactly at those six characters)."""

from __future__ import annotations

import gc
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ratewise.session import new_subdir, ship_package

WORD_SPLIT = r"[\x20\x09-\x0D]+"
BLANKS = " \t\n\x0b\x0c\r"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def ascii_lower(c: Column) -> Column:
    return F.translate(c, _UPPER, _LOWER)


def words_of(text: Column) -> Column:
    """Array of the words of a text (empty for a null, empty or blank text)."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(BLANKS))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, WORD_SPLIT))


def fold(id_col: Column, folds: int) -> Column:
    """Fold of a document: crc32 of its id as text, modulo ``folds`` (a null id counts as '')."""
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")) % folds


def written(df: DataFrame, name: str, path: str | None = None, release: bool = True) -> DataFrame:
    """Write ``df`` to a fresh table in the shared checkpoint folder and read
    it back: cuts lineage, and several later steps read it by column.  Before
    that, shuffle files of finished steps are let go: Spark removes them once
    the driver has collected the plans that refer to them."""
    spark, schema = df.sparkSession, df.schema
    path = path or new_subdir(spark, name)
    if release:
        gc.collect()
        spark.sparkContext._jvm.System.gc()
    df.write.parquet(path)
    return spark.read.schema(schema).parquet(path)


class Scratch:
    """Intermediate tables of one operator, in one folder that is removed when
    the operator has written its result: ``with Scratch(spark, name) as tmp``."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.base, self.made = spark, new_subdir(spark, name), 0
        self.kept: dict[int, tuple[DataFrame, str]] = {}

    def path(self, name: str) -> str:
        self.made += 1
        return f"{self.base}/{self.made:02d}-{name}"

    def keep(self, df: DataFrame, name: str, release: bool = True) -> DataFrame:
        path = self.path(name)
        out = written(df, name, path, release)
        self.kept[id(out)] = (out, path)
        return out

    def drop(self, table: DataFrame) -> None:
        """Remove a kept table that no later step reads."""
        self._delete(self.kept.pop(id(table))[1])

    def _delete(self, folder: str) -> None:
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *error) -> None:
        self._delete(self.base)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, made longer until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def kernel(df: DataFrame) -> SparkSession:
    """The session of ``df``, after making sure its Python workers can import this package."""
    ship_package(df.sparkSession)
    return df.sparkSession


# -- long texts ------------------------------------------------------------

# A cut between such a character and a following space or line feed is safe
# for the pre-splitting patterns of byte-level tokenizers: no match runs from
# a non-blank into a blank, and none looks behind.
_SAFE_CUT = re.compile(r"[\w!-/:-@\[-`{-~](?=[ \n])")
_ODD_BLANK = re.compile(r"[^\S \n]")
_PIECE = re.compile(r"[ \n]*[^ \n]+|[ \n]+")
_SAFE_SPLIT = re.compile(r"(?<=[\w!-/:-@\[-`{-~])(?=[ \n])")


def safe_segments(text: str, size: int = 1 << 16) -> Iterator[str]:
    """``text`` in segments of about ``size`` characters, cut at safe places
    only (a text without such places stays whole)."""
    start = 0
    while len(text) - start > size:
        cut = _SAFE_CUT.search(text, start + size - 1)
        if cut is None:
            break
        yield text[start:cut.end()]
        start = cut.end()
    yield text[start:] if start else text


def safe_pieces(text: str) -> list[str]:
    """``text`` cut at every safe place: a word with the blanks before it."""
    if _ODD_BLANK.search(text):
        return _SAFE_SPLIT.split(text)
    return _PIECE.findall(text)


def by_bytes(texts: Iterable[str], most: int) -> Iterator[list[str]]:
    """Runs of consecutive texts of about ``most`` characters each."""
    run, size = [], 0
    for t in texts:
        run.append(t)
        size += len(t)
        if size >= most:
            yield run
            run, size = [], 0
    if run:
        yield run


# -- word and shingle hashes -------------------------------------------------

_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_S30, _S27, _S31 = np.uint64(30), np.uint64(27), np.uint64(31)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (splitmix64): spreads every input bit over the word."""
    x = (x ^ (x >> _S30)) * _M1
    x = (x ^ (x >> _S27)) * _M2
    return x ^ (x >> _S31)


_BLANK = np.zeros(256, bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True
_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_PLACE, _LENGTH = np.uint64(0xD6E8FEB86659FD93), np.uint64(0xA0761D6478BD642F)


def hashed_words(texts: Iterable[str | None], lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words of the texts, one after another, and each text's number of words.

    A word's hash is a sum of one pseudo-random number for each (byte, place in the word),
    so all words of all texts are hashed together, without an object for any of them."""
    return hashed_words_and_ends(texts, lower)[:2]


def hashed_words_and_ends(texts: Iterable[str | None], lower: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The same, and each word's last two bytes as a number (under 256 for a word of one byte)."""
    parts = [(t or "").encode() for t in texts]
    data = b"\n".join(parts) + b"\n"
    if lower:
        data = data.lower()
    buf = np.frombuffer(data, np.uint8)
    inside = ~_BLANK[buf]
    edges = np.flatnonzero(np.diff(inside.view(np.int8), prepend=np.int8(0)))
    starts, ends = edges[::2], edges[1::2]
    size = np.fromiter(map(len, parts), np.int64, len(parts)) + 1
    counts = np.diff(np.searchsorted(starts, np.cumsum(size)), prepend=0)
    if not len(starts):
        return np.empty(0, np.uint64), counts, np.empty(0, np.int64)
    at = np.flatnonzero(inside)
    length = ends - starts
    offsets = np.cumsum(length) - length
    place = (np.arange(len(at)) - np.repeat(offsets, length)).astype(np.uint64)
    place *= _PLACE
    place += _BYTE[buf[at]]
    last = buf[ends - 1] + np.where(length > 1, (buf[ends - 2].astype(np.int64) + 1) << 8, 0)
    return mix(np.add.reduceat(mix(place), offsets) + length.astype(np.uint64) * _LENGTH), counts, last


def shingle_hashes(w: np.ndarray, k: int, seed: int = 0) -> np.ndarray:
    """Hash of each run of ``k`` word hashes (one hash of the whole sequence
    when there are fewer words, none without words)."""
    n = len(w)
    if n == 0:
        return w
    width = min(n, k)
    count = n - width + 1
    out = np.full(count, np.uint64((0x9E3779B97F4A7C15 * (seed + width)) & (2**64 - 1)))
    for i in range(width):
        out = mix(out ^ w[i:i + count]) + np.uint64(i + 1)
    return out


# -- groups of texts, bitmaps ---------------------------------------------------

def text_groups(batches: Iterator[pa.RecordBatch], column: str, most: int) -> Iterator[pa.RecordBatch]:
    """Slices of the batches with about ``most`` bytes of text each."""
    for b in batches:
        ends = np.cumsum(pc.fill_null(pc.binary_length(b.column(column)), 0).to_numpy(zero_copy_only=False))
        start = 0
        while start < b.num_rows:
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + most, side="right")))
            yield b.slice(start, stop - start)
            start = stop


def bitmap_of(df: DataFrame, column: str, bits: int) -> np.ndarray:
    """A bitmap of 2 ** ``bits`` bits with one set for the leading bits of each
    64-bit hash in ``column``: a filter of fixed size that lets too much through
    as it fills, never too little.  At most 2 ** bits / 8 bytes reach the driver."""
    bit = F.shiftrightunsigned(F.col(column), 64 - bits) + 1
    maps = (df.select(bit.alias("bit")).groupBy(F.bitmap_bucket_number("bit").alias("k"))
              .agg(F.bitmap_construct_agg(F.bitmap_bit_position("bit")).alias("bits")).collect())
    out = np.zeros(1 << (bits - 3), np.uint8)
    for r in maps:
        out[(r["k"] - 1) * 4096:r["k"] * 4096] = np.frombuffer(r["bits"], np.uint8)
    return out


def in_bitmap(bitmap: np.ndarray, hashes: np.ndarray, bits: int) -> np.ndarray:
    """Which of the 64-bit hashes the filter lets through."""
    bit = (hashes.view(np.uint64) >> np.uint64(64 - bits)).astype(np.int64)
    return ((bitmap[bit >> 3] >> (bit & 7).astype(np.uint8)) & 1).astype(bool)
