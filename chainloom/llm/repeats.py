"""Suffix-array dedup: bytes covered by a string of ``length`` bytes that also starts in an earlier document.

The texts of all documents are one collection. Its Burrows-Wheeler transform is built column by column, one symbol
of every string per round; the sorted order of each column puts equal strings of ``length`` bytes side by side, and the
smallest doc_id of such an interval of common prefixes decides. To keep the number of rounds fixed and the work
parallel, the collection is cut into short strings around anchors: the anchor of a window of ``length`` bytes is its smallest
hashed ``GRAM``-byte string, so equal windows have equal anchors, wherever they stand. The strings of an anchor are
all windows that chose it; the strings of one part of the anchors are one collection.

Steps: (1) anchors are packed by part, and those that only one document has are dropped; (2) documents get back
which of theirs are shared and send the strings around them; (3) each part builds its transform from distinct
strings, each with its smallest document; (4) covered ranges go back to the documents. Parts follow the input's
size; a task takes its parts one after the other, so its memory follows one part.

Edge cases: null text counts as empty; texts under ``length`` bytes lose nothing and match nothing; a string repeated within one
document only is kept; rows that repeat a doc_id are not earlier than each other
(if their texts differ, ranges found in one are removed from all of that id); rows without doc_id neither lose
bytes nor count for others; very long texts are read whole. Empty tables give no rows. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard as zstd
from pyspark.sql import DataFrame, functions as F

from chainloom.llm.common import INVERSE, Piece, mix64, pieces, powers, prefix_hashes

GRAM = 24
PARTITION_BYTES = 32_000_000  # text per partition of the anchors
STRING_PARTITIONS = 4  # partitions of the strings for each one of the anchors
PARTS = 8  # parts per partition, one after the other in a task's memory
KEY = np.uint64(2**48 - 1)


def anchors(piece: Piece, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, key, anchor byte, first window, last window) of every anchor of a piece; bytes count in the piece."""
    n = len(piece.data)
    none = tuple(np.zeros(0, np.int64) for _ in range(5))
    if n < length:
        return none
    h = prefix_hashes(piece.data)
    gram = mix64((h[GRAM:] - h[:-GRAM]) * powers(INVERSE, n + 1)[: n - GRAM + 1])
    low = ((gram >> np.uint64(32)) << np.uint64(32)) | np.arange(len(gram), dtype=np.uint64)
    width, have = length - GRAM + 1, 1
    while 2 * have <= width:
        low = np.minimum(low[:-have], low[have:])
        have *= 2
    if have < width:
        low = np.minimum(low[: len(low) - (width - have)], low[width - have :])
    at = (low & np.uint64(0xFFFFFFFF)).astype(np.int64)  # of each window start; equal hashes: the leftmost
    doc = np.repeat(np.arange(len(piece)), np.diff(piece.starts))
    start = np.flatnonzero(np.arange(len(at)) + length <= piece.starts[doc[: len(at)] + 1] - 1)
    if not len(start):
        return none
    at = at[start]
    new = np.ones(len(at), bool)
    new[1:] = (at[1:] != at[:-1]) | (start[1:] != start[:-1] + 1)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(at)) - 1
    return doc[start[first]], gram[at[first]] & KEY, at[first], start[first], start[last]


def _six(keys: np.ndarray) -> bytes:
    return keys.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6].tobytes()


def _from_six(raw) -> np.ndarray:
    out = np.zeros((len(raw) // 6, 8), np.uint8)
    out[:, :6] = np.frombuffer(raw, np.uint8).reshape(-1, 6)
    return out.view("<u8").ravel().astype(np.uint64)


def _planes(values: np.ndarray) -> bytes:
    """Differences of neighbours, first all lowest bytes and last all highest, which are mostly zeros and shuffle small."""
    steps = np.diff(values.astype("<i8"), prepend=np.int64(0))
    return np.ascontiguousarray(steps.view(np.uint8).reshape(-1, 8).T).tobytes()


def _from_planes(raw: bytes) -> np.ndarray:
    return np.cumsum(np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(8, -1).T).view("<i8").ravel())


def _runs(sorted_values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of runs of equal values."""
    if not len(sorted_values):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    start = np.flatnonzero(np.append(True, sorted_values[1:] != sorted_values[:-1]))
    return start, np.append(start[1:], len(sorted_values))


def _send_anchors(parts: int, length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches):
            ids = piece.batch.column(0).to_numpy(zero_copy_only=False)
            doc, key, *_ = anchors(piece, length)
            part = (mix64(key) % np.uint64(parts)).astype(np.int64)
            order = np.lexsort((doc, part))
            doc, key, part = doc[order], key[order], part[order]
            rows = []
            for lo, hi in zip(*_runs(part), strict=True):
                s, e = _runs(doc[lo:hi])
                rows.append((int(part[lo]), _planes(ids[doc[lo:hi][s]]), _planes(e - s), _six(key[lo:hi])))
            cols = [pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.int32(), pa.binary(), pa.binary(), pa.binary()))]
            yield pa.RecordBatch.from_arrays(cols, names=["part", "ids", "counts", "keys"])

    return run


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[dict]]]:
    """Rows of each part, from batches sorted by part."""
    part, rows = None, []
    for batch in batches:
        for row in batch.to_pylist():
            if row["part"] != part and rows:
                yield part, rows
                rows = []
            part = row["part"]
            rows.append(row)
    if rows:
        yield part, rows


def _shared_anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for _, rows in _groups(batches):
        doc = np.concatenate([np.repeat(_from_planes(r["ids"]), _from_planes(r["counts"])) for r in rows])
        key = np.concatenate([_from_six(r["keys"]) for r in rows])
        rows.clear()
        order = np.argsort(key, kind="stable")
        doc, key = doc[order], key[order]
        start, end = _runs(key)
        shared = np.minimum.reduceat(doc, start) < np.maximum.reduceat(doc, start) if len(start) else np.zeros(0, bool)
        keep = np.repeat(shared, end - start)
        doc, key = doc[keep], key[keep]
        order = np.argsort(doc, kind="stable")  # keys stay in order within a document
        doc, key = doc[order], key[order]
        new = np.ones(len(doc), bool)  # a key counts once in a document
        new[1:] = (doc[1:] != doc[:-1]) | (key[1:] != key[:-1])
        doc, key = doc[new], key[new]
        packed = _six(key)
        runs = list(zip(*_runs(doc), strict=True))
        for at in range(0, len(runs), 20_000):
            some = runs[at : at + 20_000]
            yield pa.RecordBatch.from_arrays(
                [pa.array([int(doc[lo]) for lo, _ in some], pa.int64()), pa.array([packed[6 * lo : 6 * hi] for lo, hi in some], pa.binary())],
                names=["doc_id", "keys"],
            )


def _unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches with the compressed text in column 1 as they were before compression, a few megabytes each."""
    tool = zstd.ZstdDecompressor()
    for batch in batches:
        at, texts, size = 0, [], 0
        for i in range(batch.num_rows):
            texts.append(tool.decompress(batch.column(1)[i].as_buffer()))
            size += len(texts[-1])
            if size > 2_000_000 or i + 1 == batch.num_rows:
                part = batch.slice(at, i + 1 - at)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(texts, pa.large_binary()), part.column(2)], names=["doc_id", "text", batch.schema.names[2]]
                )
                at, texts, size = i + 1, [], 0


STRINGS = "part int, docs binary, starts binary, sizes binary, anchors binary, data binary"


def _send_strings(parts: int, length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = zstd.ZstdCompressor(level=1)  # the strings of neighbouring anchors overlap
        for piece in pieces(_unpacked(batches)):
            ids = piece.batch.column(0).to_numpy(zero_copy_only=False)
            doc, key, at, first, last = anchors(piece, length)
            lists = piece.batch.column(2)
            mine = lists.flatten()
            of = np.repeat(pc.list_parent_indices(lists).to_numpy(), pc.binary_length(mine).to_numpy() // 6)
            tag = of.astype(np.uint64) << np.uint64(48)  # a piece has under 2**16 texts of ``length`` bytes
            keep = np.isin(key | doc.astype(np.uint64) << np.uint64(48), _from_six(b"".join(mine.to_pylist())) | tag)
            doc, key, at, first, last = doc[keep], key[keep], at[keep], first[keep], last[keep]
            part = (mix64(key ^ np.uint64(0x2545F4914F6CDD1D)) % np.uint64(parts)).astype(np.int64)
            order = np.argsort(part, kind="stable")
            rows = []
            for lo, hi in zip(*_runs(part[order]), strict=True):
                mine = order[lo:hi]
                size = last[mine] - first[mine] + length
                byte = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + np.repeat(first[mine], size)
                where = first[mine] - piece.starts[doc[mine]]
                small = (size.astype("u1").tobytes(), (at[mine] - first[mine]).astype("u1").tobytes())
                rows.append((int(part[mine[0]]), _planes(ids[doc[mine]]), _planes(where), *small, tool.compress(piece.data[byte].tobytes())))
            kinds = (pa.int32(), *[pa.binary()] * 5)
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)], names=["part", "docs", "starts", "sizes", "anchors", "data"])

    return run


def _words(data: np.ndarray) -> np.ndarray:
    """Eight bytes from every byte on, as one number each; ``data`` has eight bytes of padding."""
    return np.ndarray((len(data) - 7,), "<u8", data, strides=(1,))


def _earliest(data: np.ndarray, begin: np.ndarray, size: np.ndarray, anchor: np.ndarray, doc: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """For every window of the strings, in order of string and offset, the smallest document that holds it.

    Column-wise construction: the strings stand in a table with their anchors in one column. Each round takes the
    next column from the right and puts the symbol of every string that has one before its suffix. Sorting these
    symbols, which is the transform of the column, in the order of the suffixes behind them gives the order of the
    new suffixes; an ended string sorts before all symbols. Equal windows have equal anchors and so lie in one
    column, side by side in its order; their common prefixes make the intervals.
    """
    top = length - GRAM
    first = top - anchor  # column of the first byte; of the byte behind the last one
    end = first + size
    by_end = np.argsort(end, kind="stable")
    at_end = np.searchsorted(end[by_end], np.arange(top + length + 2))
    n = size - length + 1
    base = np.cumsum(n) - n
    out = np.empty(int(n.sum()), np.int64)
    words = _words(np.append(data, np.zeros(8, np.uint8)))
    offsets = [*range(0, length - 7, 8), length - 8]
    order = np.zeros(0, np.int64)
    for column in range(top + length - 1, -1, -1):
        order = np.append(by_end[at_end[column + 1] : at_end[column + 2]], order[first[order] <= column])
        order = order[np.argsort(data[begin[order] + column - first[order]], kind="stable")]
        window = order[end[order] - column >= length]
        if not len(window):
            continue
        offset = column - first[window]
        at = begin[window] + offset
        same = np.ones(len(at) - 1, bool)  # common prefix of neighbours of ``length`` or more
        for i in offsets:
            w = words[at + i]
            same &= w[1:] == w[:-1]
        start = np.flatnonzero(np.append(True, ~same))
        least = np.minimum.reduceat(doc[window], start)
        out[base[window] + offset] = np.repeat(least, np.diff(np.append(start, len(at))))
    return base, out


def _covered(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = zstd.ZstdDecompressor()
        for _, rows in _groups(batches):
            doc, where = (np.concatenate([_from_planes(r[c]) for r in rows]) for c in ("docs", "starts"))
            size, anchor = (np.concatenate([np.frombuffer(r[c], np.uint8) for r in rows]).astype(np.int64) for c in ("sizes", "anchors"))
            data = np.frombuffer(b"".join(tool.decompress(r["data"]) for r in rows), np.uint8)
            rows.clear()
            begin = np.cumsum(size) - size
            # equal strings enter once, with their smallest document
            h = prefix_hashes(data)
            end = begin + size
            base = powers(INVERSE, len(data) + 1)[begin]
            name = mix64((h[end] - h[begin]) * base + size.astype(np.uint64))
            _, one, of = np.unique(name, return_index=True, return_inverse=True)
            least = np.full(len(one), np.iinfo(np.int64).max)
            np.minimum.at(least, of, doc)
            first_window, earliest = _earliest(data, begin[one], size[one], anchor[one], least, length)
            n = size - length + 1
            window = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            hit = earliest[np.repeat(first_window[of], n) + window] < np.repeat(doc, n)
            before = np.append(False, hit[:-1]) & (window > 0)
            after = np.append(hit[1:], False) & (np.append(window[1:], 0) > 0)
            start, stop = np.flatnonzero(hit & ~before), np.flatnonzero(hit & ~after)
            if not len(start):
                continue
            string = np.repeat(np.arange(len(n)), n)[start]
            order = np.lexsort((where[string] + window[start], doc[string]))
            string, start, stop = string[order], start[order], stop[order]
            rd, ra, rb = doc[string], where[string] + window[start], where[string] + window[stop] + length
            s, e = _runs(rd)
            pairs = np.stack([ra, rb], 1).astype("<i8")
            yield pa.RecordBatch.from_arrays(
                [pa.array(rd[s]), pa.array([pairs[i:j].tobytes() for i, j in zip(s, e, strict=True)], pa.binary())], names=["doc_id", "spans"]
            )

    return run


def _kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in _unpacked(batches):
        rows = []
        for i in range(batch.num_rows):
            text = batch.column(1)[i].as_py()
            spans = np.concatenate([np.frombuffer(b.as_buffer(), "<i8").reshape(-1, 2) for b in batch.column(2)[i].values])
            spans = spans[np.argsort(spans[:, 0], kind="stable")]
            reach = np.maximum.accumulate(spans[:, 1])
            cut = np.append(True, spans[1:, 0] > reach[:-1])  # touching ranges are one
            begin, end = spans[cut, 0], np.append(reach[np.flatnonzero(cut)[1:] - 1], reach[-1])
            digest, at = hashlib.sha256(), 0
            for a, b in zip(begin.tolist(), end.tolist(), strict=True):
                digest.update(text[at:a])
                at = b
            digest.update(text[at:])
            rows.append((hashlib.sha256(text).hexdigest(), int((end - begin).sum()), len(begin), digest.hexdigest()))
        cols = [batch.column(0), *(pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.string(), pa.int64(), pa.int64(), pa.string())))]
        yield pa.RecordBatch.from_arrays(cols, names=["doc_id", "whole", "n_removed", "n_spans", "kept"])


def _compressed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    tool = zstd.ZstdCompressor(level=1)
    for batch in batches:
        texts = batch.column(1).cast(pa.large_binary())
        packed = pa.array([tool.compress(t.as_buffer()) if t.is_valid else tool.compress(b"") for t in texts], pa.binary())
        yield pa.RecordBatch.from_arrays([batch.column(0), packed], names=["doc_id", "packed"])


def covered_ranges(docs: DataFrame, length: int = 50) -> tuple[DataFrame, DataFrame]:
    """(doc_id, list of packed byte ranges covered by earlier documents) and (doc_id, compressed text).

    Both are parts of one plan: a join of the two by doc_id reads the shuffle of the compressed texts again.
    """
    docs = docs.where("doc_id is not null and octet_length(text) >= %d" % length).select(F.col("doc_id").cast("bigint"), "text")
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    partitions = max(1, -(-total // PARTITION_BYTES))
    by_part = lambda df, n: df.repartition(n, "part").sortWithinPartitions("part")
    sent = docs.mapInArrow(_send_anchors(partitions * PARTS, length), "part int, ids binary, counts binary, keys binary")
    shared = by_part(sent, partitions).mapInArrow(_shared_anchors, "doc_id bigint, keys binary")
    wanted = shared.groupBy("doc_id").agg(F.collect_list("keys").alias("keys"))  # at most the anchors of one document
    packed = docs.mapInArrow(_compressed, "doc_id bigint, packed binary")
    asked = packed.join(wanted, "doc_id")
    strings = asked.mapInArrow(_send_strings(partitions * STRING_PARTITIONS * PARTS, length), STRINGS)
    spans = by_part(strings, partitions * STRING_PARTITIONS).mapInArrow(_covered(length), "doc_id bigint, spans binary")
    return spans.groupBy("doc_id").agg(F.collect_list("spans").alias("spans")), packed


def remove_repeats(docs: DataFrame, length: int = 50) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256 of every row."""
    ranges, packed = covered_ranges(docs, length)
    cut = packed.join(ranges, "doc_id").mapInArrow(_kept, "doc_id bigint, whole string, n_removed bigint, n_spans bigint, kept string")
    cut = cut.dropDuplicates(["doc_id", "whole"])  # rows that repeat
    raw = F.coalesce(F.encode("text", "UTF-8"), F.lit(b""))
    every = docs.select(F.col("doc_id").cast("bigint"), F.length(raw).cast("bigint").alias("n_bytes"), F.sha2(raw, 256).alias("whole"))
    return every.join(cut, ["doc_id", "whole"], "left").select(
        "doc_id",
        "n_bytes",
        F.coalesce("n_removed", F.lit(0)).cast("bigint").alias("n_removed"),
        F.coalesce("n_spans", F.lit(0)).cast("bigint").alias("n_spans"),
        F.coalesce("kept", "whole").alias("kept_sha256"),
    )
