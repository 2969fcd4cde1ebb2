"""N-gram Jaccard join with set-relation skipping.

Documents with equal shingle sets are one class. Each class enters the index with a prefix of its shingles
in an order that puts frequent ones last, taken from its head, the smallest shingles of its text; two sets above
the threshold share at least ``_need`` shingles of their prefixes. The index lists are in blocks by set size and by
position in the prefix, both part of the join key: an entry meets only blocks near enough that the two positions leave
room for a similar pair. Entries that can meet none are left out of the lists.

Answers are reused between similar sets. Every block of a list has a leader, its first class; a class is
compared with its leaders, and the shingles in which it differs from the first similar one, its flips, are kept. Two
classes of one leader differ in just the shingles that one of their flips has and the other's lacks, so their
answer follows from the flips without their texts. Flips come in blocks by their number, and blocks whose numbers
lie too far apart are skipped. Index lists are searched only between classes of different leaders. Leaders meet
first: Jaccard distance is a metric, so two leaders' distance and the distances of their members to them rule out
members, or both groups, without a look at their sets. What is written per group is its links at most, never its pairs.

Edge cases: null and empty texts have an empty set and no link; a text of fewer words than a shingle is one
shingle; rows of one doc_id are sets of their own under that id; a row without doc_id has a set, but no
component_id unless it shares its set or is linked. Ties need no order. Very long texts are read whole. Empty tables give no
rows. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import log

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from chainloom.llm.common import Piece, by_merge, combine, marked, mix64, pieces, stored, words_of
from chainloom.llm.components import components

SETS = "doc_id bigint, th bigint, n bigint, d1 bigint, d2 bigint, head array<bigint>"
_LAST = np.uint64(1) << np.uint64(63)
_NO_ID = -(2**63)


def shingle_sets(piece: Piece, size: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingles of each text, as 64-bit hashes."""
    w = words_of(piece)
    h = w.hash
    grams = combine(*(h[i : len(h) - size + 1 + i] for i in range(size))) if len(h) >= size else h[:0]
    for lo, hi in zip(w.bounds[:-1].tolist(), w.bounds[1:].tolist(), strict=True):
        if hi - lo >= size:
            yield np.unique(grams[lo : hi - size + 1])
        elif hi > lo:
            yield combine(*(h[i : i + 1] for i in range(lo, hi)))
        else:
            yield h[:0]


def need(n: np.ndarray) -> np.ndarray:
    """Shared prefix shingles asked for; grows with the set, so that chance matches of long texts drop out."""
    return 1 + np.minimum(4, n // 40)


def _need(n: Column) -> Column:
    return F.lit(1) + F.least(F.lit(4), (n / 40).cast("bigint"))


def _length(n: np.ndarray, num: int, den: int) -> np.ndarray:
    """Prefix length of sets of these sizes."""
    return np.minimum(n, n - -(-num * n // den) + need(n))


def _joined(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(values of all sets in a row, their ends behind a 0)."""
    ends = np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int64)
    return np.concatenate([*sets, np.zeros(0, np.uint64)]), ends


def _lists(flat: np.ndarray, ends: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat.view(np.int64)))


def _sets(docs: DataFrame, size: int, num: int, den: int) -> DataFrame:
    """Set size, digest and head of every document.

    A head holds the smallest shingles, twice as many as a prefix. So a prefix by another order can be taken from it
    as long as no more than half of it comes last in that order, without a look at the text.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches):
            n, d1, d2, heads = [], [], [], []
            for s in shingle_sets(piece, size):
                a = mix64(s ^ np.uint64(0x5851F42D4C957F2D))
                n.append(len(s))
                d1.append(a.sum(dtype=np.uint64))
                d2.append(mix64(a).sum(dtype=np.uint64))
                heads.append(s[: 2 * int(_length(np.array(len(s)), num, den))])
            cols = [
                piece.batch.column(0),
                piece.batch.column(1),
                pa.array(n, pa.int64()),
                pa.array(np.array(d1, np.uint64).view(np.int64)),
                pa.array(np.array(d2, np.uint64).view(np.int64)),
                _lists(*_joined(heads)),
            ]
            yield pa.RecordBatch.from_arrays(cols, names=["doc_id", "th", "n", "d1", "d2", "head"])

    return docs.select(F.col("doc_id").cast("bigint"), F.xxhash64("text").alias("th"), "text").mapInArrow(run, SETS)


def _put_last(flat: np.ndarray, ends: np.ndarray, n: np.ndarray, num: int, den: int, last: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(prefixes, their ends, rows too short) of sets of size ``n`` by the order that puts the shingles ``last`` last.

    ``flat`` holds the smallest shingles of each set. Where these are not the whole set and too few of them come
    before ``last``, the row is too short and gets no prefix.
    """
    held = np.diff(ends)
    k = _length(n, num, den)
    row = np.repeat(np.arange(len(held)), held)
    light = np.ones(len(flat), bool)
    if len(last):
        known = np.zeros(2**20, bool)
        known[(last >> np.uint64(44)).astype(np.int64)] = True
        maybe = np.flatnonzero(known[(flat >> np.uint64(44)).astype(np.int64)])
        light[maybe] = ~_among(flat[maybe], last)
    before = np.concatenate([[0], np.cumsum(light)])
    lights = before[ends[1:]] - before[ends[:-1]]
    rank = before[:-1] - before[ends[:-1]][row]  # light shingles of the row before this one
    place = np.where(light, rank, lights[row] + np.arange(len(flat)) - ends[:-1][row] - rank)
    short = (lights < k) & (held < n)
    keep = (place < k[row]) & ~short[row]
    out_ends = np.concatenate([[0], np.cumsum(np.where(short, 0, np.minimum(k, held)))])
    out = np.zeros(out_ends[-1], np.uint64)
    out[out_ends[:-1][row[keep]] + place[keep]] = flat[keep]
    return out, out_ends, short


def _reordered(
    flat: np.ndarray, ends: np.ndarray, n: np.ndarray, num: int, den: int, heavy: np.ndarray, new: np.ndarray | None
) -> tuple[np.ndarray, pa.ListArray, np.ndarray]:
    """(rows, their prefixes, rows too short) by the order that puts ``heavy`` and ``new`` last.

    With ``new``, only rows whose prefix by the order of ``heavy`` holds one of these further shingles: all other
    prefixes are the same in both orders.
    """
    out, out_ends, short = _put_last(flat, ends, n, num, den, heavy if new is None else np.union1d(heavy, new))
    use = ~short
    if new is not None:
        was, was_ends, _ = _put_last(flat, ends, n, num, den, heavy)
        hits = np.concatenate([[0], np.cumsum(_among(was, new))])
        use &= hits[was_ends[1:]] > hits[was_ends[:-1]]
    size = np.diff(out_ends)
    return np.flatnonzero(use), _lists(out[np.repeat(use, size)], np.concatenate([[0], np.cumsum(size[use])])), np.flatnonzero(short)


def _slices(batch: pa.RecordBatch, limit: int = 1 << 17) -> Iterator[pa.RecordBatch]:
    """The batch in slices of at most ``limit`` shingles in their heads, one row at least, to bound a task's memory."""
    if not batch.num_rows:
        return
    ends = np.asarray(batch.column("head").offsets)
    start = 0
    while start < batch.num_rows:
        stop = max(start + 1, int(np.searchsorted(ends, ends[start] + limit, "right")) - 1)
        yield batch.slice(start, stop - start)
        start = stop


def _prefixes(docs: DataFrame, reps: DataFrame, size: int, num: int, den: int, heavy: np.ndarray, new: np.ndarray | None = None) -> DataFrame:
    """(cid, n, prefix) of classes by the order that puts ``heavy`` and ``new`` last; with ``new``, of those this changes.

    They are taken from the heads; only classes whose head is too short are made from their texts again.
    """
    shared = docs.sparkSession.sparkContext.broadcast((heavy, new))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in _slices(whole)):
            n, head = batch.column("n").to_numpy(), batch.column("head")
            ends = np.asarray(head.offsets).astype(np.int64)
            flat = head.values.to_numpy()[ends[0] : ends[-1]].view(np.uint64)
            rows, prefixes, short = _reordered(flat, ends - ends[0], n, num, den, *shared.value)
            take = pa.array(np.concatenate([rows, short]))
            empty = _lists(np.zeros(0, np.uint64), np.zeros(len(short) + 1, np.int64))
            cols = [batch.column(c).take(take) for c in ("cid", "n", "id", "th")]
            cols += [pa.concat_arrays([prefixes, empty]), pa.array(np.arange(len(take)) >= len(rows))]
            yield pa.RecordBatch.from_arrays(cols, names=["cid", "n", "id", "th", "prefix", "short"])

    def run_whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches):
            flat, ends = _joined(list(shingle_sets(piece, size)))
            n = np.diff(ends)
            rows, prefixes, _ = _reordered(flat, ends, n, num, den, *shared.value)
            cols = [piece.batch.column(c).take(pa.array(rows)) for c in (0, 1)]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(n[rows]), prefixes], names=["id", "th", "n", "prefix"])

    seen = reps.mapInArrow(run, "cid bigint, n bigint, id bigint, th bigint, prefix array<bigint>, short boolean")
    out = seen.where("not short").select("cid", "n", "prefix")
    if not len(heavy) and new is None:
        return out
    short = stored(seen.where("short").select("cid", "id", "th"), "jaccard-short")
    if short.isEmpty():
        return out
    texts = marked(_texts(docs), short, ["id", "th"]).where("maybe").select("id", "th", "text")
    whole = texts.mapInArrow(run_whole, "id bigint, th bigint, n bigint, prefix array<bigint>")
    return out.unionByName(whole.join(short, ["id", "th"]).select("cid", "n", "prefix"))


def _texts(docs: DataFrame) -> DataFrame:
    """Texts by the id and hash that name a class's first document."""
    return docs.select(F.coalesce(F.col("doc_id").cast("bigint"), F.lit(_NO_ID)).alias("id"), F.xxhash64("text").alias("th"), "text")


def _among(values: np.ndarray, of: np.ndarray) -> np.ndarray:
    """Which of the values the sorted array holds."""
    return of[np.minimum(np.searchsorted(of, values), len(of) - 1)] == values if len(of) else np.zeros(len(values), bool)


def _representatives(sets: DataFrame, classes: DataFrame) -> DataFrame:
    """Id, size and head of each class, from its first document (twice if that row is repeated, which does no harm)."""
    same = sets.where("n > 0").join(by_merge(classes), ["n", "d1", "d2"])
    first = same.where((F.col("doc_id").eqNullSafe(F.col("doc_min"))) & (F.col("th") == F.col("th_min")))
    return first.select("cid", "n", F.coalesce("doc_id", F.lit(_NO_ID)).alias("id"), "th", "head")


def _heavy(counts: DataFrame, least: int, most: int) -> np.ndarray:
    """The shingles that ``least`` prefixes or more hold, of counts (t, k): the ``most`` most frequent ones, a bounded list.

    Their place in the order is a matter of speed alone, so a list cut at ``most`` loses no result.
    """
    rows = counts.where(F.col("k") >= least).orderBy(F.desc("k"), "t").limit(most).select("t").toPandas()["t"].to_numpy(np.int64)
    return np.sort(rows.view(np.uint64))


def _frequent(docs: DataFrame, reps: DataFrame, size: int, num: int, den: int, least: int, most: int, rounds: int = 3) -> np.ndarray:
    """The shingles that go last: those that are frequent in the prefixes by hash, and in those that these make.

    With some shingles put last, prefixes reach further and hold others that are as frequent, as a passage does that
    very many documents share. So the prefixes that change are counted again, for ``rounds`` rounds at most. Prefixes
    that don't change hold a shingle less than ``least`` times, or it would be in the list, so what is left out is in
    less than twice as many. Only the order is made here: no pair is lost by it.
    """
    def often(prefixes: DataFrame) -> np.ndarray:
        return _heavy(prefixes.select(F.explode("prefix").alias("t")).groupBy("t").agg(F.count(F.lit(1)).alias("k")), least, most)

    heavy = np.zeros(0, np.uint64)
    new = often(_prefixes(docs, reps, size, num, den, heavy))
    for _ in range(rounds):
        if not len(new):
            break
        changed = _prefixes(docs, reps, size, num, den, heavy, new)
        heavy = np.union1d(heavy, new)
        new = np.setdiff1d(often(changed), heavy)
    return np.union1d(heavy, new)


def _compare(
    pairs: DataFrame, docs: DataFrame, classes: DataFrame, purpose: str, size: int, similar: float, with_flips: bool = True, chunk: int = 256
) -> DataFrame:
    """(a, b, shared, flips) of pairs of classes with a similarity of ``similar`` or more, from their whole sets.

    Flips are empty without ``with_flips``. Rows of one ``a`` are dealt in chunks of about ``chunk``, each with one copy of a's text, and streamed.
    """
    counts = pairs.groupBy("a").agg((F.count(F.lit(1)) / chunk).cast("int").alias("last"))
    left = counts.select("a", F.explode(F.sequence(F.lit(0), "last")).alias("part"), F.lit(0).alias("kind"), F.col("a").alias("b"))
    right = pairs.join(counts, "a").select("a", F.pmod(F.xxhash64("b"), F.col("last") + 1).cast("int").alias("part"), F.lit(1).alias("kind"), "b")
    ids = classes.select(F.col("cid").alias("b"), F.coalesce("doc_min", F.lit(_NO_ID)).alias("id"), F.col("th_min").alias("th"))
    want = stored(left.unionByName(right).join(by_merge(ids), "b"), f"{purpose}-wanted")
    # most texts are not wanted, so they are left where they are; the others go to their pairs without a stop
    rows = (
        marked(_texts(docs), want, ["id", "th"])
        .where("maybe")
        .drop("maybe")
        .join(by_merge(want), ["id", "th"])
        .repartition("a", "part")
        .sortWithinPartitions("a", "part", "kind")
        .select("a", "b", "kind", "text")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mine = np.zeros(0, np.uint64)
        for piece in pieces(batches):
            a, b, kind = (piece.batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
            keep, shared, flips, ends = [], [], [np.zeros(0, np.uint64)], [0]
            for i, s in enumerate(shingle_sets(piece, size)):
                if kind[i] == 0:
                    mine = s
                    continue
                both = len(np.intersect1d(mine, s, assume_unique=True))
                if both >= similar * (len(mine) + len(s) - both):
                    keep.append(i)
                    shared.append(both)
                    flips.append(np.setxor1d(mine, s, assume_unique=True) if with_flips else s[:0])
                    ends.append(ends[-1] + len(flips[-1]))
            cols = [
                pa.array(a[keep]),
                pa.array(b[keep]),
                pa.array(shared, pa.int64()),
                pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(flips).view(np.int64))),
            ]
            yield pa.RecordBatch.from_arrays(cols, names=["a", "b", "shared", "flips"])

    return rows.mapInArrow(run, "a bigint, b bigint, shared bigint, flips array<bigint>")


def _links_of_blocks(left: tuple, right: tuple, num: int, den: int) -> list[tuple[int, int]]:
    """Links between two blocks of members (cid, n, root, flips) of one leader, enough of them to join their roots."""
    cid, n, root = (np.concatenate([left[i], right[i]]) for i in range(3))
    sets = left[3] + right[3]
    size = np.array([len(f) for f in sets])
    flat = np.concatenate(sets) if size.sum() else np.zeros(0, np.int64)
    values, of, held = np.unique(flat, return_inverse=True, return_counts=True)
    row = np.repeat(np.arange(len(sets)), size)
    common = held[of] > 1
    _, column = np.unique(of[common], return_inverse=True)
    dense = np.zeros((len(sets), int(column.max()) + 1 if len(column) else 1), np.float32)
    dense[row[common], column] = 1
    k = len(left[0])
    shared = dense[:k] @ dense[k:].T
    differ = size[:k, None] + size[None, k:] - 2 * shared
    linked = (differ * (den + num) <= (n[:k, None] + n[None, k:]) * (den - num)) & (root[:k, None] != root[None, k:])
    up = {int(r): int(r) for r in root}

    def find(x: int) -> int:
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    out = []
    for i, j in zip(*np.nonzero(linked), strict=True):
        x, y = find(int(root[i])), find(int(root[k + j]))
        if x != y:
            up[x] = y
            out.append((int(cid[i]), int(cid[k + j])))
    return out


def _meeting(postings: DataFrame, num: int, den: int) -> DataFrame:
    """The entries (t, cid, n, pos, band, shifted, e) of index lists that another entry of their list may meet.

    Sets of a similar pair lie in the same size band or in neighbouring ones, and their excesses ``e`` sum to 0 at
    most. Per list its number of entries, the bands in use modulo 64 and the least and greatest excess are enough to
    drop most entries that meet none; what they can't decide stays.
    """
    # sets differ in at most (na + nb) (den - num) / (den + num) shingles; e is a position's excess over n times that
    # and over the shared shingles before it, whose number is that of the largest set that can be similar
    partner = _need(F.ceil(F.col("n") * den / num))
    band = (F.log("n") / log(den / num) + 1e-9).cast("int")
    e = F.floor(F.col("pos") - F.col("n") * (den - num) / (den + num) - (partner - 1) - 1e-9)
    held = postings.select("t", band.alias("band"), e.alias("e")).groupBy("t").agg(
        F.count(F.lit(1)).alias("k"), F.expr("bit_or(shiftleft(1L, band % 64))").alias("bands"), F.min("e").alias("lo"), F.max("e").alias("hi")
    )
    beside = F.expr("shiftleft(bands, 1) | shiftrightunsigned(bands, 63) | shiftrightunsigned(bands, 1) | shiftleft(bands, 63)")
    held = held.where("k > 2 or k = 2 and lo + hi <= 0").withColumn("beside", beside).where("bit_count(bands) < k or (bands & beside) <> 0")
    held = held.select("t", "lo", F.expr("if(bit_count(bands) < k, -1L, beside)").alias("beside"))
    return (
        postings.join(held, "t")
        .select("*", band.alias("band"), F.expr(f"cast(ln(n) / {log(den / num)!r} + 0.5 as int)").alias("shifted"), e.alias("e"))
        .where("e + lo <= 0 and getbit(beside, band % 64) = 1")
        .drop("lo", "beside")
    )


def _leader_pairs(rows: DataFrame, num: int, den: int, blocks: int = 8) -> DataFrame:
    """(t, band, lead, band_b, lead_b, least) of groups of different leaders that meet in a list; group b has the smaller sets.

    The excess ``e`` of an entry is its position beyond half of what a similar pair may differ by; excesses of a
    similar pair sum to 0 at most. So an entry of excess f > 0 goes to its own position block, and one of
    excess -m to the blocks up to m, besides the block in which entries without excess meet.
    """
    groups = rows.groupBy("t", "band", "lead").agg(F.min("e").alias("e"), F.min("n").alias("least"))
    apart = (den - num) / den - (den - num) / (den + num)
    smaller = groups.withColumn("at", F.explode(F.array("band", F.col("band") + 1)))
    larger = groups.withColumn("at", F.col("band"))

    def placed(df: DataFrame, far: int, near: int) -> DataFrame:
        width = F.greatest(F.lit(1.0), F.ceil(F.pow(F.lit(den / num), F.col("at")) * (apart * 2 / blocks)))
        block = F.least(F.floor(F.abs("e") / width), F.lit(blocks)).cast("int")
        low = F.concat(F.array(F.lit(0)), F.transform(F.sequence(F.lit(0), block), lambda j: j * 2 + near))
        return df.withColumn("block", F.explode(F.when(F.col("e") > 0, F.array(block * 2 + far)).otherwise(low)))

    a = placed(larger, 1, 2)
    b = placed(smaller, 2, 1).select(
        "t", "at", "block", F.col("band").alias("band_b"), F.col("lead").alias("lead_b"), F.col("e").alias("e_b"), F.col("least").alias("least_b")
    )
    return by_merge(a).join(b, ["t", "at", "block"]).where("lead <> lead_b and e + e_b <= 0").select(
        "t", "band", "lead", "band_b", "lead_b", F.least("least", "least_b").alias("least")
    )


def _within_leaders(members: DataFrame, num: int, den: int, block: int = 256, salts: int = 64) -> DataFrame:
    """Links (a, b) between members (leader, cid, n, root, flips) of one leader that lie in different components."""
    open_ = members.groupBy("leader").agg(
        F.max("n").alias("top"), F.min("root").alias("x"), F.max("root").alias("y")
    ).where("x <> y").select("leader", "top")
    # similar members differ in their number of flips by (n + n') (den - num) / (den + num) at most: a band at most
    width = F.greatest(F.lit(1), F.ceil(F.col("top") * (2 * (den - num)) / (den + num)))
    # a leader may have very many members: they are dealt by a salt, and the leader's row is repeated for each
    salted = members.withColumn("salt", F.pmod(F.xxhash64("cid"), F.lit(salts)).cast("int"))
    open_ = open_.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    rows = salted.join(by_merge(open_), ["leader", "salt"]).drop("salt").withColumn("band", (F.size("flips") / width).cast("int"))
    counts = rows.groupBy("leader", "band").agg((F.count(F.lit(1)) / block).cast("int").alias("last"))
    rows = rows.join(counts, ["leader", "band"]).withColumn("part", F.pmod(F.xxhash64("cid"), F.col("last") + 1).cast("int"))
    blocks = stored(
        rows.groupBy("leader", "band", "part").agg(
            F.collect_list(F.struct("cid", "n", "root", "flips")).alias("m"), F.min("root").alias("x"), F.max("root").alias("y")
        ),
        "jaccard-blocks",
    )
    b = blocks.select("leader", F.explode(F.array("band", F.col("band") + 1)).alias("band"), F.col("band").alias("own"), F.col("part").alias("other"), F.col("m").alias("w"), F.col("x").alias("bx"), F.col("y").alias("by"))
    pairs = blocks.join(by_merge(b), ["leader", "band"]).where("(own < band or other <= part) and not (x = y and bx = by and x = bx)").select("m", "w").repartition(F.rand(5))

    def side(column: pa.Array, i: int) -> tuple:
        s = column.slice(i, 1).flatten()
        flips = s.field(3)
        flat, at = flips.values.to_numpy(zero_copy_only=False), np.asarray(flips.offsets)
        return (*(s.field(c).to_numpy(zero_copy_only=False) for c in range(3)), [flat[at[j] : at[j + 1]] for j in range(len(s))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                found = _links_of_blocks(side(batch.column(0), i), side(batch.column(1), i), num, den)
                yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in found], pa.int64()) for c in (0, 1)], names=["a", "b"])

    return pairs.mapInArrow(run, "a bigint, b bigint")


def jaccard_join(
    docs: DataFrame,
    *,
    size: int = 5,
    num: int = 8,
    den: int = 10,
    heavy_least: int = 24,
    heavy_most: int = 131_072,
    similar: float = 0.4,
) -> DataFrame:
    """doc_id, n_shingles, class_id (smallest doc_id of the same set) and component_id of every row.

    Two documents are linked when den * |intersection| >= num * |union|.
    """
    first = stored(_sets(docs, size, num, den), "jaccard-sets")
    classes = stored(
        first.where("n > 0")
        .groupBy("n", "d1", "d2")
        .agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "th")).alias("m"))
        .select("n", "d1", "d2", F.col("m.doc_id").alias("doc_min"), F.col("m.th").alias("th_min"))
        .orderBy("doc_min")  # so that leaders, the smallest ids, are the earliest documents: originals rather than copies
        .withColumn("cid", F.monotonically_increasing_id()),
        "jaccard-classes",
    )
    reps = stored(_representatives(first, classes), "jaccard-heads")
    heavy = _frequent(docs, reps, size, num, den, heavy_least, heavy_most)
    prefixes = _prefixes(docs, reps, size, num, den, heavy)
    postings = stored(prefixes.select("cid", "n", F.posexplode("prefix").alias("pos", "t")).select("t", "cid", "n", "pos"), "jaccard-postings")
    lists = stored(_meeting(postings, num, den), "jaccard-lists")
    fits = (F.least("na", "nb") * den >= F.greatest("na", "nb") * num) & (
        (F.col("pa") + F.col("pb") - 2 * (F.greatest(_need(F.col("na")), _need(F.col("nb"))) - 1)) * (den + num)
        <= (F.col("na") + F.col("nb")) * (den - num)
    )
    def side(df: DataFrame, x: str) -> DataFrame:
        return df.select("t", "band", "lead", F.col("cid").alias(x), F.col("n").alias(f"n{x}"), F.col("pos").alias(f"p{x}"), F.col("dist").alias(f"d{x}"))

    def counted(met: DataFrame) -> DataFrame:
        return met.where(fits).groupBy("a", "b").agg(F.first("na").alias("na"), F.first("nb").alias("nb"), F.count(F.lit(1)).alias("k"))

    def linked(compared: DataFrame) -> DataFrame:
        return compared.where(F.col("shared") * den >= (F.col("na") + F.col("nb") - F.col("shared")) * num).select("a", "b")

    # 1. every class against the leaders of its lists: the first class of a size block, for two divisions into blocks
    met = None
    for band in ("band", "shifted"):
        lead = lists.groupBy("t", band).agg(F.min(F.struct("cid", "n", "pos")).alias("m"), F.count(F.lit(1)).alias("k")).where("k > 1")
        lead = lead.select("t", band, F.col("m.cid").alias("a"), F.col("m.n").alias("na"), F.col("m.pos").alias("pa"))
        rows = lists.select("t", band, F.col("cid").alias("b"), F.col("n").alias("nb"), F.col("pos").alias("pb"))
        part = lead.join(by_merge(rows), ["t", band]).where("a <> b").drop("t", band)
        met = part if met is None else met.unionByName(part)
    pairs = stored(counted(met).where(F.col("k") >= _need(F.least("na", "nb"))).drop("k"), "jaccard-leaders")
    compared = stored(
        _compare(pairs.select("a", "b"), docs, classes, "jaccard-leader-texts", size, similar).join(pairs, ["a", "b"]),
        "jaccard-answers",
    )
    distance = 1 - F.col("shared") / (F.col("na") + F.col("nb") - F.col("shared"))
    first_leader = stored(
        compared.withColumn("dist", distance).groupBy("b").agg(F.min(F.struct("a", "flips", "nb", "dist")).alias("m")).select(
            F.col("b").alias("cid"), F.col("m.a").alias("lead"), F.col("m.flips").alias("flips"), F.col("m.nb").alias("n"), F.col("m.dist").alias("dist")
        ),
        "jaccard-led",
    )
    # 2. the index between classes of different leaders: their lists meet by leader first, then by member
    rows = lists.join(first_leader.select("cid", "lead", "dist"), "cid", "left")
    rows = rows.withColumns({"lead": F.coalesce("lead", "cid"), "dist": F.coalesce("dist", F.lit(0.0))})
    open_lists = rows.groupBy("t").agg(F.min("lead").alias("x"), F.max("lead").alias("y")).where("x <> y").select("t")
    rows = stored(rows.join(open_lists, "t"), "jaccard-open")
    x, y = F.least("lead", "lead_b").alias("a"), F.greatest("lead", "lead_b").alias("b")
    groups = stored(_leader_pairs(rows, num, den).select("*", x, y), "jaccard-groups")
    radius = first_leader.groupBy("lead").agg(F.max("dist").alias("r"))
    leaders = groups.groupBy("a", "b").agg(F.min("least").alias("least"), F.countDistinct("t").alias("k")).where(F.col("k") >= _need(F.col("least")))
    for c in "ab":
        leaders = leaders.join(radius.select(F.col("lead").alias(c), F.col("r").alias(f"r{c}")), c, "left")
    leaders = stored(leaders.select("a", "b", F.coalesce("ra", F.lit(0.0)).alias("ra"), F.coalesce("rb", F.lit(0.0)).alias("rb")), "jaccard-leader-pairs")
    # leaders without members are left to the comparison of members
    wide = leaders.where("ra + rb > 0")
    sizes = classes.select("cid", "n")
    apart = _compare(wide.select("a", "b"), docs, classes, "jaccard-group-texts", size, 0.0, with_flips=False).drop("flips")
    apart = apart.join(wide, ["a", "b"]).join(sizes.select(F.col("cid").alias("a"), F.col("n").alias("na")), "a").join(sizes.select(F.col("cid").alias("b"), F.col("n").alias("nb")), "b")
    reach = 1 - num / den + 1e-9
    apart = apart.select("a", "b", "ra", "rb", distance.alias("d")).where(F.col("d") <= F.col("ra") + F.col("rb") + reach)
    kept = stored(apart.unionByName(leaders.where("ra + rb = 0").withColumn("d", F.lit(0.0))), "jaccard-near-groups")
    met = groups.drop("least").join(kept, ["a", "b"]).withColumn("r_b", F.when(F.col("lead_b") == F.col("b"), F.col("rb")).otherwise(F.col("ra")))
    met = met.select("t", "band", "lead", "band_b", "lead_b", "d", "r_b").join(by_merge(side(rows, "a")), ["t", "band", "lead"]).where(F.col("da") + F.col("r_b") + reach >= F.col("d"))
    b = side(rows, "b").withColumnsRenamed({"band": "band_b", "lead": "lead_b"})
    met = met.join(by_merge(b), ["t", "band_b", "lead_b"]).where((F.col("da") + F.col("db") + reach >= F.col("d")) & F.expr("nb < na or (nb = na and b < a)"))
    pairs = stored(counted(met).where(F.col("k") >= _need(F.least("na", "nb"))).drop("k"), "jaccard-pairs")
    between = stored(
        _compare(pairs.select("a", "b"), docs, classes, "jaccard-texts", size, num / den - 1e-9, with_flips=False).drop("flips").join(pairs, ["a", "b"]),
        "jaccard-between",
    )
    links = stored(linked(compared).unionByName(linked(between)), "jaccard-links")
    roots = stored(components(links, "jaccard-first"), "jaccard-roots")
    # 3. classes of one leader, from their flips
    led = first_leader.select(F.col("lead").alias("leader"), "cid", "n", "flips")
    leaders = first_leader.select(F.col("lead").alias("leader"), F.col("lead").alias("cid")).distinct()
    leaders = leaders.join(classes.select("cid", "n"), "cid").select("leader", "cid", "n", F.array().cast("array<bigint>").alias("flips"))
    members = led.unionByName(leaders).join(roots.withColumnRenamed("node", "cid"), "cid", "left").withColumn("root", F.coalesce("root", "cid"))
    more = stored(_within_leaders(members, num, den), "jaccard-within")
    roots = stored(components(links.unionByName(more), "jaccard-all"), "jaccard-roots")
    classed = classes.join(roots.withColumnRenamed("node", "cid"), "cid", "left").withColumn("root", F.coalesce("root", "cid"))
    classed = classed.join(classed.groupBy("root").agg(F.min("doc_min").alias("component_id")), "root")
    classed = classed.select("n", "d1", "d2", F.col("doc_min").alias("class_id"), "component_id")
    alone = F.col("n") == 0
    return first.join(classed, ["n", "d1", "d2"], "left").select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(alone, F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.when(alone, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
    )
