"""Cross-tokenizer alignment by pointer jumping.

Two tokenizers cut the same bytes. Every token points to its farthest-right overlapping token (of equal ends, to the
second tokenizer's); successor doubling, ``p = p[p]`` over all tokens of a piece at once, ends at the terminal token of
each component, which labels the component's tokens. The components are the groups: byte ranges between offsets where
tokens of both end. All pairs of a first and a second token of one group are links. A pair of ids counts the documents
that hold it linked.

Whole texts are encoded once. A task gives consecutive documents of about ``block_bytes`` one block: its distinct id
pairs with the number of its documents holding them, and per document its pairs as numbers into that list. Blocks go to
the shared folder. A pair occurs once in a block, so no key is hot: pairs are summed over blocks, joined back to the
blocks' lists, and each block meets its documents again.

Edge cases: null and empty texts, and texts whose token bytes of either tokenizer differ from a space and the text
(they hold the mark that stands for a space, say), have no tokens: zeros and an empty digest. Repeated rows and rows that repeat an id are
documents each, and count each; a null id stays null. Groups of any size are linked whole: large ones by their distinct
ids with how often they occur. Other columns are ignored. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from chainloom.llm.common import Piece, pieces, stored

FIRST = "/opt/tokenizers/byte_bpe_50k.json"
SECOND = "/opt/tokenizers/piece_bpe_32k.model"

# Fixed value: the published word pattern of byte-level pair encoding.
WORDS = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

_LONG_SPACE = re.compile(r"\s{5000}")
#: Links handled at once, and the size from which a group goes by its distinct ids.
_CHUNK, _LARGE = 2_000_000, 65_536

ENCODED = (
    "block bigint, doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string, "
    "links binary, pairs binary, docs binary"
)
ALIGNED = (
    "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint, groups_sha256 string"
)


def _byte_letters() -> dict[str, int]:
    """Letters that stand for bytes in a byte-level vocabulary: printable ones for themselves, the rest from 256 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Bytes:
    """The byte string of every id, as one buffer."""

    def __init__(self, table: list[bytes]):
        self.length = np.array([len(t) for t in table], np.int64)
        self.start = np.cumsum(self.length) - self.length
        self.data = np.frombuffer(b"".join(table), np.uint8)

    def of(self, ids: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """All bytes of a sequence of ids."""
        ends = np.cumsum(lengths)
        shift = np.repeat(self.start[ids] - (ends - lengths), lengths)
        return self.data[shift + np.arange(len(shift))]


class FirstTokenizer:
    """Byte-level pair encoding from its JSON file; texts get a space in front, special strings are plain text.

    Where merges stand in id order, which is checked, ranks are ids and the faster encoder of ranks gives the same ids.
    It can't take white space of great length; such texts go to the encoder of the file.
    """

    def __init__(self, file: bytes):
        from tokenizers import Tokenizer

        self.slow = Tokenizer.from_str(file.decode())
        self.slow.encode_special_tokens = True
        vocab = self.slow.get_vocab(with_added_tokens=False)
        letters = _byte_letters()
        table = [b""] * (max(self.slow.get_vocab().values()) + 1)
        for token, i in vocab.items():
            table[i] = bytes(letters[c] for c in token)
        self.bytes, self.fast = Bytes(table), None
        spec = json.loads(file)
        model, before = spec["model"], spec["pre_tokenizer"] or {}
        merged = ["".join(m) if isinstance(m, list) else m.replace(" ", "", 1) for m in model["merges"]]
        plain = before.get("type") == "ByteLevel" and before.get("use_regex") and not before.get("add_prefix_space")
        if plain and not spec["normalizer"] and [vocab[m] for m in merged] == list(range(256, 256 + len(merged))):
            import tiktoken

            ranks = {table[i]: i for i in vocab.values()}
            self.fast = tiktoken.Encoding("first", pat_str=WORDS, mergeable_ranks=ranks, special_tokens={})

    def encode(self, text: str) -> np.ndarray:
        if self.fast is not None and not _LONG_SPACE.search(text):
            return self.fast.encode_to_numpy(" " + text, disallowed_special=()).astype(np.int64)
        return np.array(self.slow.encode(" " + text, add_special_tokens=False).ids, np.int64)


class SecondTokenizer:
    """Sentence pieces with byte fallback; the model itself puts a space in front."""

    def __init__(self, file: bytes):
        from sentencepiece import SentencePieceProcessor

        self.model = SentencePieceProcessor(model_proto=file)
        n = self.model.get_piece_size()
        byte = re.compile("<0x([0-9A-F]{2})>")
        table = []
        for i, piece in enumerate(self.model.id_to_piece(list(range(n)))):
            as_byte = byte.fullmatch(piece) if self.model.is_byte(i) else None
            table.append(bytes([int(as_byte[1], 16)]) if as_byte else piece.replace("▁", " ").encode())
        self.bytes = Bytes(table)

    def encode(self, text: str) -> np.ndarray:
        return np.array(self.model.encode(text, num_threads=1), np.int64)


@lru_cache(maxsize=2)
def _tokenizers(files: tuple[bytes, bytes]):
    return FirstTokenizer(files[0]), SecondTokenizer(files[1])


def terminals(end_a: np.ndarray, end_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The terminal token (its number in the second sequence) of every token of both sequences.

    Both sequences cut the same bytes without holes.
    """
    start_a, start_b = np.concatenate(([0], end_a[:-1])), np.concatenate(([0], end_b[:-1]))
    n_a, own = len(end_a), np.arange(len(end_b))
    to_b = np.searchsorted(start_b, end_a, "left") - 1  # ends no earlier than the token itself
    to_a = np.searchsorted(start_a, end_b, "left") - 1
    p = np.concatenate((n_a + to_b, np.where(end_a[to_a] > end_b, to_a, n_a + own)))
    while True:
        q = p[p]
        if np.array_equal(p, q):
            return p[:n_a] - n_a, p[n_a:] - n_a
        p = q


def _tally(keys: np.ndarray, weights: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, with the sum of their weights (1 each by default)."""
    if weights is None:
        keys = np.sort(keys)
    else:
        order = np.argsort(keys, kind="stable")
        keys, weights = keys[order], weights[order]
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else np.zeros(0, np.int64)
    if weights is None:
        return keys[first], np.diff(np.append(first, len(keys)))
    return keys[first], np.add.reduceat(weights, first) if len(first) else weights


def _links(a, b, group_a, per_a, per_b, start_b, doc_of_group, n_b_ids: int, n_ids: int):
    """Distinct (document, pair) keys and how many links each stands for."""
    found: list[tuple[np.ndarray, np.ndarray]] = []
    large = per_a * per_b > _LARGE
    base = doc_of_group[group_a] * n_ids + a * n_b_ids
    times = np.where(large[group_a], 0, per_b[group_a])
    total = np.cumsum(times)
    at = 0
    while at < len(a):
        before = total[at - 1] if at else 0
        stop = max(at + 1, int(np.searchsorted(total, before + _CHUNK, "right")))
        n = times[at:stop]
        place = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(start_b[group_a[at:stop]], n)
        found.append(_tally(np.repeat(base[at:stop], n) + b[place]))
        at = stop
    for g in np.flatnonzero(large):
        lo, hi = np.searchsorted(group_a, g, "left"), np.searchsorted(group_a, g, "right")
        ka, wa = _tally(base[lo:hi])
        kb, wb = _tally(b[start_b[g] : start_b[g] + per_b[g]])
        step = max(1, _CHUNK // len(kb))
        for i in range(0, len(ka), step):
            found.append(_tally((ka[i : i + step, None] + kb).ravel(), (wa[i : i + step, None] * wb).ravel()))
    if len(found) == 1:
        return found[0]
    return _tally(np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found]))


class PairList:
    """The distinct id pairs of a block, numbered as they come, with the documents holding each."""

    def __init__(self):
        self.keys, self.numbers = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.n = 0
        self.docs = np.zeros(0, np.int64)

    def add(self, keys: np.ndarray, docs: np.ndarray) -> np.ndarray:
        """Numbers of ascending distinct keys."""
        at = np.searchsorted(self.keys, keys)
        known = np.zeros(len(keys), bool)
        inside = at < self.n
        known[inside] = self.keys[at[inside]] == keys[inside]
        fresh = ~known
        numbers = np.empty(len(keys), np.int64)
        numbers[known] = self.numbers[at[known]]
        numbers[fresh] = self.n + np.arange(fresh.sum())
        self.keys = np.insert(self.keys, at[fresh], keys[fresh])
        self.numbers = np.insert(self.numbers, at[fresh], numbers[fresh])
        self.n = len(self.keys)
        self.docs = np.append(self.docs, np.zeros(fresh.sum(), np.int64))
        self.docs[numbers] += docs
        return numbers

    def row(self) -> tuple[bytes, bytes]:
        keys = np.empty(self.n, np.int64)
        keys[self.numbers] = self.keys
        return keys.tobytes(), self.docs.tobytes()


def _pack(numbers: np.ndarray, times: np.ndarray, squeeze: zstandard.ZstdCompressor) -> bytes:
    """Pair numbers and repeats, byte planes apart, as most high bytes are zero."""
    times_4 = np.minimum(times, 2**32 - 1).astype("<u4")  # a document of more links than that would take terabytes
    planes = [x.view(np.uint8).reshape(-1, 4).T.tobytes() for x in (numbers.astype("<u4"), times_4)]
    return squeeze.compress(b"".join(planes))


def _unpack(packed: bytes, expand: zstandard.ZstdDecompressor) -> tuple[np.ndarray, np.ndarray]:
    raw = np.frombuffer(expand.decompress(packed), np.uint8).reshape(2, 4, -1)
    return tuple(np.ascontiguousarray(raw[i].T).view("<u4").ravel().astype(np.int64) for i in (0, 1))


class Aligner:
    """Groups, links and digests of the documents of a piece."""

    def __init__(self, files: tuple[bytes, bytes]):
        self.first, self.second = _tokenizers(files)
        self.n_b_ids = len(self.second.bytes.length)
        self.n_ids = len(self.first.bytes.length) * self.n_b_ids
        self.wide = max(len(self.first.bytes.length), self.n_b_ids)
        self.shown = np.array([f"{i}{mark}" for mark in ",|;" for i in range(self.wide)], object)

    def _encode(self, texts: list[str | None], piece: Piece):
        """Ids of both tokenizers per text that they cut without changing it."""
        kept, ids_a, ids_b = [], [], []
        for d, text in enumerate(texts):
            if not text:
                continue
            want = np.empty(piece.starts[d + 1] - piece.starts[d], np.uint8)
            want[0], want[1:] = 0x20, piece.data[piece.starts[d] : piece.starts[d + 1] - 1]
            found = []
            for tokenizer in (self.first, self.second):
                ids = tokenizer.encode(text)
                lengths = tokenizer.bytes.length[ids]
                if lengths.sum() == len(want) and np.array_equal(tokenizer.bytes.of(ids, lengths), want):
                    found.append(ids)
            if len(found) == 2:
                kept.append(d)
                ids_a.append(found[0])
                ids_b.append(found[1])
        return np.array(kept, np.int64), ids_a, ids_b

    def align(self, piece: Piece, texts: list[str | None]):
        """Per document: sizes and digest; and distinct (document, pair) keys with their links."""
        n = len(texts)
        sizes, digests = np.zeros((4, n), np.int64), [""] * n
        kept, ids_a, ids_b = self._encode(texts, piece)
        if not len(kept):
            return sizes, digests, np.zeros(0, np.int64), np.zeros(0, np.int64)
        n_a, n_b = (np.array([len(x) for x in ids]) for ids in (ids_a, ids_b))
        a, b = np.concatenate(ids_a), np.concatenate(ids_b)
        end_a, end_b = np.cumsum(self.first.bytes.length[a]), np.cumsum(self.second.bytes.length[b])
        last_a, last_b = terminals(end_a, end_b)
        number = np.cumsum(last_b == np.arange(len(b))) - 1
        group_a, group_b = number[last_a], number[last_b]
        groups = int(number[-1]) + 1
        per_a, per_b = np.bincount(group_a, minlength=groups), np.bincount(group_b, minlength=groups)
        stop_a, stop_b = np.cumsum(per_a), np.cumsum(per_b)
        start_b = stop_b - per_b
        doc_of_group = np.searchsorted(np.cumsum(n_b), start_b, "right")
        sizes[0, kept], sizes[1, kept] = n_a, n_b
        sizes[2, kept] = np.bincount(doc_of_group, minlength=len(kept))
        edges = np.searchsorted(doc_of_group, np.arange(len(kept)))
        sizes[3, kept] = np.add.reduceat(per_a * per_b, edges)
        # the tokens of a group, first those of one tokenizer, then those of the other
        text_of = np.empty(len(a) + len(b), np.int64)
        text_of[np.arange(len(a)) + start_b[group_a]] = a
        text_of[np.arange(len(b)) + stop_a[group_b]] = b
        text_of[stop_a + start_b - 1] += self.wide
        text_of[stop_a + stop_b - 1] += 2 * self.wide
        shown = self.shown[text_of].tolist()
        at = 0
        for d, m in zip(kept.tolist(), (n_a + n_b).tolist(), strict=True):
            digests[d] = hashlib.sha256("".join(shown[at : at + m])[:-1].encode()).hexdigest()
            at += m
        keys, times = _links(a, b, group_a, per_a, per_b, start_b, kept[doc_of_group], self.n_b_ids, self.n_ids)
        return sizes, digests, keys, times


_ENCODED_TYPES = [pa.int64()] * 6 + [pa.string()] + [pa.binary()] * 3
_ENCODED_NAMES = [c.split()[0] for c in ENCODED.split(", ")]


def _encode_blocks(files: tuple[bytes, bytes], block_bytes: int, block_pairs: int, batches: Iterator[pa.RecordBatch]):
    context = TaskContext.get()
    block = (context.partitionId() if context else 0) << 32
    aligner, listed, used = Aligner(files), PairList(), 0
    squeeze = zstandard.ZstdCompressor(level=1)

    def batch_of(columns):
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, _ENCODED_TYPES, strict=True)], names=_ENCODED_NAMES)

    def close():
        return batch_of([[block], *[[None]] * 7, *[[x] for x in listed.row()]])

    for piece in pieces(batches):
        doc_ids = piece.batch.column(0)
        sizes, digests, keys, times = aligner.align(piece, piece.batch.column(1).to_pylist())
        doc, pair = keys // aligner.n_ids, keys % aligner.n_ids
        distinct, inverse, docs = np.unique(pair, return_inverse=True, return_counts=True)
        numbers = listed.add(distinct, docs)[inverse]
        edges = np.searchsorted(doc, np.arange(len(piece) + 1))
        links = [
            _pack(numbers[lo:hi], times[lo:hi], squeeze) if hi > lo else None
            for lo, hi in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True)
        ]
        none = [None] * len(piece)
        yield batch_of([[block] * len(piece), doc_ids, *sizes, digests, links, none, none])
        used += len(piece.data)
        if used >= block_bytes or listed.n >= block_pairs:
            yield close()
            block, listed, used = block + 1, PairList(), 0
    if used:
        yield close()


def encode(docs: DataFrame, first: str = FIRST, second: str = SECOND, block_bytes: int = 32_000_000, block_pairs: int = 1_000_000) -> DataFrame:
    """Rows of documents and of blocks (those with ``pairs``); not stored yet.

    The two tokenizer files, read on the driver, go to the tasks by a broadcast of a few megabytes.
    """
    files = []
    for path in (first, second):
        with open(path, "rb") as f:
            files.append(f.read())
    sent = docs.sparkSession.sparkContext.broadcast(tuple(files))
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return rows.mapInArrow(lambda it: _encode_blocks(sent.value, block_bytes, block_pairs, it), ENCODED)


def _unlist(n_b_ids: int, batches: Iterator[pa.RecordBatch], step: int = 200_000):
    """(block, number, a, b, docs) rows of the pair lists."""
    for batch in batches:
        for i in range(batch.num_rows):
            keys, docs = (np.frombuffer(batch.column(c)[i].as_buffer(), np.int64) for c in (1, 2))
            for at in range(0, len(keys), step):
                key, number = keys[at : at + step], np.arange(at, min(at + step, len(keys)))
                columns = (np.full(len(key), batch.column(0)[i].as_py()), number, key // n_b_ids, key % n_b_ids, docs[at : at + step])
                kinds = (pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=["block", "number", "a", "b", "docs"]
                )


def _sums(documents: pa.Table, pairs: pa.Table) -> pa.Table:
    """The documents of a block with the counts of their links."""
    number = pairs.column("number").to_numpy()
    counts, best = np.zeros(len(number), np.int64), np.zeros(len(number), np.int64)
    counts[number] = pairs.column("docs").to_numpy()
    best[number] = pairs.column("best").to_numpy(zero_copy_only=False)
    expand, n_best, count_sum = zstandard.ZstdDecompressor(), [], []
    for packed in documents.column("links").to_pylist():
        at, times = _unpack(packed, expand) if packed else (np.zeros(0, np.int64),) * 2
        n_best.append(int(best[at] @ times))
        count_sum.append(int(counts[at] @ times))
    out = documents.select(["doc_id", "n_a", "n_b", "n_groups", "n_links"])
    out = out.append_column("n_best", pa.array(n_best, pa.int64())).append_column("count_sum", pa.array(count_sum, pa.int64()))
    return out.append_column("groups_sha256", documents.column("groups_sha256"))


def pair_counts(encoded: DataFrame, n_b_ids: int) -> DataFrame:
    """(block, number, a, b, docs): the pair lists of stored blocks; ``docs`` of a block's own documents."""
    listed = encoded.where("pairs is not null").select("block", "pairs", "docs")
    return listed.mapInArrow(lambda it: _unlist(n_b_ids, it), "block bigint, number int, a int, b int, docs bigint")


def align(docs: DataFrame, first: str = FIRST, second: str = SECOND, **blocks: int) -> DataFrame:
    """Per document: tokens, groups, links, links of the best count, the sum of link counts, and the digest of its groups."""
    with open(second, "rb") as f:
        n_b_ids = len(SecondTokenizer(f.read()).bytes.length)
    encoded = stored(encode(docs, first, second, **blocks), "alignment-blocks")
    listed = pair_counts(encoded, n_b_ids)
    counts = stored(listed.groupBy("a", "b").agg(F.sum("docs").alias("docs")), "alignment-counts")
    highest = counts.groupBy("a").agg(F.max("docs").alias("highest"))
    known = counts.join(highest, "a").select("a", "b", "docs", (F.col("docs") == F.col("highest")).alias("best"))
    looked_up = listed.drop("docs").join(known, ["a", "b"]).select("block", "number", "docs", "best")
    documents = encoded.where("pairs is null").drop("pairs", "docs")
    both = documents.groupBy("block").cogroup(looked_up.groupBy("block"))
    return both.applyInArrow(_sums, ALIGNED)
