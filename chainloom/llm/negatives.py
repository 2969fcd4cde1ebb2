"""Hard negatives by Four-Russians scoring.

Vectors are whole numbers (components times a scale, rounded down). A candidate lies as bit planes: for every plane of
its two's complement and every group of eight dimensions one byte says which of the eight have that bit. An anchor lies
as tables: for every group the sums of all 256 subsets of its eight components. A plane's share of the inner product is
one lookup a group, and the exact score is the shares shifted by their plane and added, the top plane subtracted.

Candidates are packed where they are read, in blocks; anchors in chunks. Each chunk meets every block twice: first for
an anchor's positives (the best rows of its label), then, with the positives known, for the rows of other labels whose
score lies in the band below each positive. A task keeps the best few of a block, Spark the best few of all.

Edge cases: rows with a null id, label or vector, or with a null or non-finite component, take no part; vectors of
unequal length are padded with zeros, so an empty one scores 0. Rows that repeat an id are anchors and candidates each,
but never partners of an anchor of that id. Equal scores go by smaller id. Anchors without positives or negatives give no
rows, nor does an empty table. Other columns are ignored. Products must fit 64 bits.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from chainloom.llm.common import by_merge, stored

BLOCK = "block bigint, ids binary, labels binary, planes binary"
CHUNK = "chunk bigint, a_ids binary, a_labels binary, vectors binary"
PARTIAL = "chunk bigint, place int, vec_id bigint, score bigint"
FOUND = "chunk bigint, place int, position int, vec_id bigint, score bigint"
NEGATIVES = "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint"

#: Rows of a block scored at once; with a chunk's anchors they stay in a core's cache.
_STEP = 512


def whole(vectors: DataFrame, scale: int) -> DataFrame:
    """vec_id, label and v (array<bigint>) of the rows that take part."""
    bad = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = vectors.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull() & ~bad)
    return rows.select(
        F.col("vec_id").cast("bigint"),
        F.col("label").cast("bigint"),
        F.transform("embedding", lambda x: F.floor(x.cast("double") * scale)).alias("v"),
    )


def _matrix(column: pa.Array, groups: int) -> np.ndarray:
    """Vectors of a list column side by side, padded to whole groups of eight."""
    sizes = np.diff(np.asarray(column.offsets))
    flat = column.flatten().to_numpy(zero_copy_only=False)
    out = np.zeros((len(column), 8 * groups), np.int64)
    out[np.repeat(np.arange(len(column)), sizes), np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out


def bit_planes(x: np.ndarray, planes: int) -> np.ndarray:
    """Bytes [plane, group, row] of the two's complement of ``x`` in ``planes`` bits."""
    n, dims = x.shape
    bits = ((x[None, :, :] >> np.arange(planes)[:, None, None]) & 1).astype(np.uint8)
    return np.ascontiguousarray(np.packbits(bits.reshape(planes, n, dims // 8, 8), axis=-1, bitorder="little")[..., 0].transpose(0, 2, 1))


def subset_sums(anchors: np.ndarray, kind: type) -> np.ndarray:
    """Tables [group, subset, anchor]: each table is doubled by adding one component to all subsets so far."""
    n, dims = anchors.shape
    parts = anchors.reshape(n, dims // 8, 8).transpose(1, 2, 0).astype(kind)
    table = np.zeros((dims // 8, 256, n), kind)
    for d in range(8):
        table[:, 1 << d : 2 << d] = table[:, : 1 << d] + parts[:, d : d + 1]
    return table


def scores(tables: np.ndarray, planes: np.ndarray) -> np.ndarray:
    """Exact inner products [row, anchor] by shifted lookups."""
    top = len(planes) - 1
    total = np.zeros((planes.shape[2], tables.shape[2]), tables.dtype)
    for b, plane in enumerate(planes):
        share = tables[0].take(plane[0], axis=0)
        for g in range(1, len(tables)):
            share += tables[g].take(plane[g], axis=0)
        share <<= b
        if b < top:
            total += share
        else:
            total -= share
    return total


def _numbered(prefix: str):
    """Numbers of the rows a task packs; unique, and the same if the task is run again."""
    context = TaskContext.get()
    at = (context.partitionId() if context else 0) << 32
    while True:
        yield at
        at += 1


def _packed_rows(batches: Iterator[pa.RecordBatch], groups: int, planes: int, most: int, schema: str) -> Iterator[pa.RecordBatch]:
    names = [c.split()[0] for c in schema.split(", ")]
    numbers = _numbered(names[0])
    for batch in batches:
        for at in range(0, batch.num_rows, most):
            part = batch.slice(at, most)
            ids, labels = (part.column(c).to_numpy(zero_copy_only=False) for c in (0, 1))
            order = np.argsort(ids, kind="stable")
            x = _matrix(part.column(2), groups)[order]
            body = bit_planes(x, planes) if planes else x
            row = (next(numbers), ids[order].tobytes(), labels[order].tobytes(), body.tobytes())
            kinds = (pa.int64(), pa.binary(), pa.binary(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds, strict=True)], names=names)


class _Chunk:
    """The anchors of a chunk with their tables; tasks meet a chunk with one block after the other and keep the last."""

    last: tuple[int, object] | None = None

    def __init__(self, row: dict, groups: int, kind: type):
        self.ids, self.labels = np.frombuffer(row["a_ids"], np.int64), np.frombuffer(row["a_labels"], np.int64)
        self.tables = subset_sums(np.frombuffer(row["vectors"], np.int64).reshape(-1, 8 * groups), kind)

    @classmethod
    def of(cls, number: int, row: dict, groups: int, kind: type) -> _Chunk:
        if cls.last is None or cls.last[0] != (number, row["a_ids"], row["vectors"]):
            cls.last = ((number, row["a_ids"], row["vectors"]), cls(row, groups, kind))
        return cls.last[1]


def _best(anchor: np.ndarray, ids: np.ndarray, score: np.ndarray, k: int, key: np.ndarray | None = None):
    """Of (anchor, id, score) triples the k best of each anchor; positions, ordered."""
    order = np.lexsort((ids, -score, anchor))
    first = np.searchsorted(anchor[order], anchor[order], "left")
    return order[np.arange(len(order)) - first < k]


def _positives(chunk: _Chunk, ids, labels, planes, k: int):
    """(place, id, score) of each anchor's best rows of its own label among those of a block."""
    found = []
    for at in range(0, len(ids), _STEP):
        s = scores(chunk.tables, planes[:, :, at : at + _STEP])
        fits = (labels[at : at + _STEP, None] == chunk.labels) & (ids[at : at + _STEP, None] != chunk.ids)
        if len(s) > k:
            low = np.iinfo(s.dtype).min
            fits &= s >= np.partition(np.where(fits, s, low), len(s) - k, axis=0)[len(s) - k]
        row, place = np.nonzero(fits)
        triple = (place, ids[at + row], s[row, place].astype(np.int64))
        keep = _best(*triple, k)
        found.append([x[keep] for x in triple])
    place, vec_id, score = (np.concatenate([f[c] for f in found]) for c in range(3))
    keep = _best(place, vec_id, score, k)
    return place[keep], vec_id[keep], score[keep]


def _negatives(chunk: _Chunk, ids, labels, planes, known: np.ndarray, k: int, low: int, high: int, unit: int):
    """(place, position, id, score) of the best rows of other labels in the band of each known positive.

    ``known`` [position, place] holds the positives' scores as floats, NaN where there are fewer.
    """
    least, most = np.nanmin(known, axis=0), np.nanmax(known, axis=0)
    found = []
    for at in range(0, len(ids), _STEP):
        s = scores(chunk.tables, planes[:, :, at : at + _STEP])
        # a wide net in floats; the bands are taken in whole numbers below
        wide = (s >= np.minimum(low * least, low * most) / unit - 1) & (s <= np.maximum(high * most, high * least) / unit + 1)
        wide &= (labels[at : at + _STEP, None] != chunk.labels) & (ids[at : at + _STEP, None] != chunk.ids)
        row, place = np.nonzero(wide)
        vec_id, score = ids[at + row], s[row, place].astype(np.int64)
        for position in range(len(known)):
            goal = known[position, place]
            there = ~np.isnan(goal)
            goal = np.where(there, goal, 0).astype(np.int64)
            keep = np.flatnonzero(there & (low * goal <= unit * score) & (unit * score <= high * goal))
            keep = keep[_best(place[keep], vec_id[keep], score[keep], k)]
            found.append((place[keep], np.full(len(keep), position), vec_id[keep], score[keep]))
    place, position, vec_id, score = (np.concatenate([f[c] for f in found]) for c in range(4))
    keep = _best(place * len(known) + position, vec_id, score, k)
    return place[keep], position[keep], vec_id[keep], score[keep]


def _scan(pairs: DataFrame, groups: int, planes: int, kind: type, schema: str, work) -> DataFrame:
    """Apply ``work`` to every (chunk, block) row."""
    names = [c.split()[0] for c in schema.split(", ")]
    kinds = [pa.int64() if c.endswith("bigint") else pa.int32() for c in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = {n: batch.column(n)[i].as_py() for n in batch.schema.names}
                chunk = _Chunk.of(row["chunk"], row, groups, kind)
                ids, labels = np.frombuffer(row["ids"], np.int64), np.frombuffer(row["labels"], np.int64)
                out = work(chunk, ids, labels, np.frombuffer(row["planes"], np.uint8).reshape(planes, groups, -1), row.get("known"))
                if len(out[0]):
                    columns = [np.full(len(out[0]), row["chunk"]), *out]
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=names)

    return pairs.mapInArrow(run, schema)


def _known(known: list[dict], places: int, most: int) -> np.ndarray:
    out = np.full((most, places), np.nan)
    for p in known:
        out[p["position"], p["place"]] = p["score"]
    return out


def hard_negatives(
    vectors: DataFrame, is_anchor: Column, *, positives: int = 5, negatives: int = 5, low: int = 80, high: int = 100, unit: int = 100,
    scale: int = 256, block: int = 4096, chunk: int = 256,
) -> DataFrame:
    """For each anchor and each of its ``positives`` best rows of its label: the ``negatives`` best rows of other labels
    whose score times ``unit`` lies between ``low`` and ``high`` times the positive's.
    """
    rows = stored(whole(vectors, scale), "negatives-vectors")
    none = rows.sparkSession.createDataFrame([], NEGATIVES)
    size = rows.agg(
        F.max(F.size("v")).alias("dims"), F.max(F.array_max("v")).alias("top"), F.min(F.array_min("v")).alias("bottom"), F.count_if(is_anchor).alias("anchors")
    ).first()
    if not size["anchors"]:
        return none
    groups = max(1, math.ceil(size["dims"] / 8))
    far = max(size["top"] or 0, -(size["bottom"] or 0) - 1, 1)
    planes = far.bit_length() + 1
    kind = np.int32 if 8 * groups * (far + 1) << planes < 2**31 else np.int64

    blocks = stored(rows.mapInArrow(lambda it: _packed_rows(it, groups, planes, block, BLOCK), BLOCK), "negatives-blocks")
    chunks = rows.where(is_anchor).repartition(math.ceil(size["anchors"] / chunk))
    chunks = stored(chunks.mapInArrow(lambda it: _packed_rows(it, groups, 0, chunk, CHUNK), CHUNK), "negatives-anchors")

    # the stated anchors meet all rows, in blocks: every chunk goes to every group of a few blocks
    n_groups = max(1, math.ceil(blocks.count() / 4))
    dealt = blocks.withColumn("group", F.pmod(F.xxhash64("block"), F.lit(n_groups))).drop("block")

    def met(left: DataFrame) -> DataFrame:
        every = F.sequence(F.lit(0).cast("bigint"), F.lit(n_groups - 1).cast("bigint"))
        return by_merge(left.withColumn("group", F.explode(every))).join(dealt, "group").drop("group")

    first = _scan(met(chunks), groups, planes, kind, PARTIAL, lambda c, i, n, p, _: _positives(c, i, n, p, positives))
    best = W.partitionBy("chunk", "place").orderBy(F.desc("score"), "vec_id")
    found = first.withColumn("position", F.row_number().over(best) - 1).where(F.col("position") < positives)
    found = stored(found.select("chunk", "place", F.col("position").cast("int"), "vec_id", "score"), "negatives-positives")
    known = found.groupBy("chunk").agg(F.collect_list(F.struct("place", "position", "score")).alias("known"))  # a few per anchor of a chunk

    def second(c, ids, labels, planes_, listed):
        return _negatives(c, ids, labels, planes_, _known(listed, len(c.ids), positives), negatives, low, high, unit)

    bands = _scan(met(chunks.join(known, "chunk")), groups, planes, kind, FOUND, second)
    hard = W.partitionBy("chunk", "place", "position").orderBy(F.desc("score"), "vec_id")
    ranked = bands.withColumn("rank", F.row_number().over(hard)).where(F.col("rank") <= negatives)
    named = chunks.mapInArrow(_anchor_ids, "chunk bigint, place int, anchor_id bigint")
    return (
        ranked.withColumnsRenamed({"vec_id": "negative_id", "score": "negative_score"})
        .join(found.withColumnsRenamed({"vec_id": "positive_id", "score": "positive_score"}), ["chunk", "place", "position"])
        .join(named, ["chunk", "place"])
        .select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score")
    )


def _anchor_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for number, ids in zip(batch.column("chunk").to_pylist(), batch.column("a_ids").to_pylist(), strict=True):
            anchor = np.frombuffer(ids, np.int64)
            columns = (np.full(len(anchor), number), np.arange(len(anchor)), anchor)
            kinds = (pa.int64(), pa.int32(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=["chunk", "place", "anchor_id"])
