"""Shared pieces of the text operators: table access, byte buffers of whole texts, word hashes.

Texts are read as UTF-8 bytes straight from Arrow. Work goes through pieces of a few megabytes, cut
between documents, so a task's memory follows the longest document and not the partition.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, functions as F

from chainloom.session import cut

PIECE_BYTES = 2_000_000
SKETCH_BITS = 1 << 23


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """Write a step to the shared folder and read it back: computed once, no lineage behind it."""
    return cut(df, f"llm-{purpose}")


def marked(df: DataFrame, of: DataFrame, keys: list[str]) -> DataFrame:
    """``df`` with a column ``maybe``, false only where no row of ``of`` has the same keys.

    The hashes of the keys of ``of`` are sketched in 2**23 bits, which are broadcast in words of 64, 131,072 at most however
    many rows there are. So rows with wide columns that meet nothing need no shuffle; a join after it is still exact.
    """
    bit = F.xxhash64(*keys).bitwiseAND(F.lit(SKETCH_BITS - 1))
    word, place = F.shiftright(bit, 6).alias("_word"), bit.bitwiseAND(F.lit(63)).cast("int")
    words = of.select(word, place.alias("_at")).groupBy("_word").agg(F.expr("bit_or(shiftleft(1L, _at))").alias("_bits"))
    met = df.withColumns({"_word": word, "_at": place}).join(F.broadcast(words), "_word", "left")
    return met.withColumn("maybe", F.coalesce(F.expr("getbit(_bits, _at) = 1"), F.lit(False))).drop("_word", "_at", "_bits")


def by_merge(df: DataFrame) -> DataFrame:
    """``df`` as a side of a join that shuffles and sorts both its sides.

    For sides that Spark takes for many times smaller than they are, and would gather on the driver to broadcast them: rows
    repeated by an explode, whose size it takes from before the explode, and stored numbers, which take far less room in a file.
    """
    return df.hint("merge")


def mix64(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64: spreads a 64-bit value over all its bits."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
_BYTE_CODES = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))
_LOWER_CODES = _BYTE_CODES.copy()
_LOWER_CODES[65:91] = _BYTE_CODES[97:123]
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64; kept between calls."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        size = max(n, 2 * PIECE_BYTES)
        have = np.full(size, base, np.uint64)
        have[0] = 1
        have = np.cumprod(have, dtype=np.uint64)
        if size <= 4 * PIECE_BYTES:
            _powers[base] = have
    return have[:n]


INVERSE = pow(BASE, -1, 2**64)


def prefix_hashes(data: np.ndarray, codes: np.ndarray = _BYTE_CODES) -> np.ndarray:
    """h[i] = hash of data[:i]; the hash of data[a:b] is (h[b] - h[a]) * INVERSE**a."""
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(codes[data] * powers(BASE, len(data)), out=out[1:])
    return out


@dataclass
class Piece:
    """Some whole texts as one byte buffer; text d is data[starts[d]:starts[d + 1] - 1]."""

    batch: pa.RecordBatch
    data: np.ndarray
    starts: np.ndarray

    def __len__(self) -> int:
        return len(self.starts) - 1


def buffer(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of all texts with a newline behind each, their starts)."""
    raw = pc.fill_null(texts.cast(pa.large_binary()), b"")
    joined = pc.binary_join_element_wise(raw, pa.scalar(b"", pa.large_binary()), pa.scalar(b"\n", pa.large_binary()))
    starts = np.frombuffer(joined.buffers()[1], np.int64)[joined.offset : joined.offset + len(joined) + 1]
    data = np.frombuffer(joined.buffers()[2], np.uint8)[starts[0] : starts[-1]]
    return data, starts - starts[0]


def pieces(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = PIECE_BYTES) -> Iterator[Piece]:
    """Cut batches into pieces of at most ``limit`` bytes, one document at least. Null texts are empty."""
    for batch in batches:
        if not batch.num_rows:
            continue
        at = batch.schema.get_field_index(column)
        sizes = pc.fill_null(pc.binary_length(batch.column(at)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes + 1)
        start = 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + limit, "right")))
            part = batch.slice(start, stop - start)
            yield Piece(part, *buffer(part.column(at)))
            start = stop


@dataclass
class Words:
    """Words of a piece in order: byte bounds, 64-bit hashes, and the range of words of each text."""

    begin: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    bounds: np.ndarray

    def doc(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.bounds) - 1), np.diff(self.bounds))


def words_of(piece: Piece, lower: bool = True) -> Words:
    """Maximal runs of bytes other than ASCII white space; A-Z count as a-z with ``lower``."""
    space = _SPACE[piece.data]
    edge = np.flatnonzero(np.diff(np.concatenate(([True], space)).view(np.int8)))
    begin, end = edge[0::2], edge[1::2]  # every text ends in a newline, so edges come in pairs
    h = prefix_hashes(piece.data, _LOWER_CODES if lower else _BYTE_CODES)
    hashes = mix64((h[end] - h[begin]) * powers(INVERSE, len(piece.data) + 1)[begin])
    return Words(begin, end, hashes, np.searchsorted(begin, piece.starts))


def combine(*parts: np.ndarray) -> np.ndarray:
    """One hash for a sequence of word hashes; order and length count."""
    out = np.full(parts[0].shape, len(parts), np.uint64)
    for p in parts:
        out = mix64(out * np.uint64(0xD1B54A32D192ED03) + p)
    return out
