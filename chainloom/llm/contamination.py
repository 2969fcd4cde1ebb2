"""Benchmark decontamination: a BM25 index of test items, queried by every passage with block-max WAND.

Passages are overlapping runs of ``2 * HALF`` words of the training texts; the index holds the test items (long
ones in parts). Scores are BM25, divided by the item's own score, so 1 means that the passage holds all
of it. WAND's bounds are taken over arrays of passages: the sum of the terms' highest impacts
drops whole passages, the sum of their highest impacts in a block of items drops blocks, and only what is left
is scored in full. All items above the threshold are retrieved, then the share of the question's and of the
answer's word trigrams found in the text around the passage decides.

Words are runs of letters, digits and combining marks, in any case: punctuation, glued to a word or not, parts
words and is left out, in items and texts alike. An item that has none but punctuation is compared by its runs
of characters other than white space. ``start_word`` counts the words so made.

The last sentence of an item is its answer, the rest its question; a single sentence is parted after three
quarters of its words. An answer of few words is also compared together with the words before it, one more than
it has itself, so that a changed word leaves it several trigrams and the question alone never holds half of them;
the better of both shares counts. The index is broadcast in shards of at most ``shard_items`` items, a bounded size; more
items mean more shards, each a pass over the texts.

Edge cases: null or empty texts and items match nothing; very long texts are read whole; equal items are all
reported; rows that repeat are reported each. Empty tables give no rows. Other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from chainloom.llm.common import Piece, Words, buffer, combine, pieces, words_of

HALF, BLOCK, K1, B = 64, 16, 1.2, 0.75
SHORT = 5  # words of a short answer
HITS = "doc_id bigint, item_id bigint, start_word bigint, score double, question_overlap double, answer_overlap double"


_BLANK = np.arange(256, dtype=np.uint8)
_BLANK[[i for i in range(128) if not chr(i).isalnum() and i != 0x0A]] = 0x20


def _fold(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and starts of texts in one case, with a blank for everything but letters, digits, combining marks and newlines."""
    texts = texts.cast(pa.large_string())
    try:
        one_case = pc.utf8_lower(pc.utf8_upper(texts))  # forms that only differ in lower case, as of sigma, become one
    except pa.ArrowInvalid:  # bytes that are no UTF-8
        texts = [None if t is None else t.decode("utf-8", "replace") for t in texts.cast(pa.large_binary()).to_pylist()]
        one_case = pc.utf8_lower(pc.utf8_upper(pa.array(texts, pa.large_string())))
    one_case = pc.replace_substring(one_case, "\u00df", "ss")
    data, starts = buffer(pc.replace_substring_regex(one_case, r"[^\p{L}\p{N}\p{M}\x00-\x7F]+", " "))
    return _BLANK[data], starts


def folded(piece: Piece) -> Piece:
    at = piece.batch.schema.get_field_index("text")
    return Piece(piece.batch, *_fold(piece.batch.column(at)))


def _hashes(text: str, fold: bool) -> np.ndarray:
    piece = next(pieces(iter([pa.RecordBatch.from_arrays([pa.array([text], pa.large_string())], names=["text"])])))
    return words_of(folded(piece) if fold else piece).hash


def _has_words(text: str) -> bool:
    return bool(_fold(pa.array([text]))[0].tobytes().strip())


def _grams(h: np.ndarray) -> np.ndarray:
    n = min(3, len(h))
    return np.unique(combine(*(h[i : len(h) - n + 1 + i] for i in range(n)))) if n else h


def split_item(text: str) -> tuple[str, str]:
    """(question, answer) of a test item."""
    parts = [p for p in re.split(r"(?<=[.!?])\s+", text.strip()) if p]
    if len(parts) > 1:
        return " ".join(parts[:-1]), parts[-1]
    words = text.split()
    cut = max(1, (3 * len(words)) // 4)
    return " ".join(words[:cut]), " ".join(words[cut:])


def _with_context(whole: np.ndarray, answer: np.ndarray) -> np.ndarray:
    """Trigrams of a short answer and the words before it; none of an answer of many words."""
    k = len(answer)
    return _grams(whole[-(2 * k + 1) :]) if 0 < k <= SHORT else whole[:0]


@dataclass
class Index:
    terms: np.ndarray  # sorted word hashes
    filter: np.ndarray  # of 2**20 hash heads, those that occur
    start: np.ndarray  # postings of each term, by item
    item: np.ndarray
    impact: np.ndarray
    highest: np.ndarray  # impact of each term
    block_start: np.ndarray  # block postings of each term
    block: np.ndarray
    block_high: np.ndarray
    owner: np.ndarray  # item_id of each indexed part
    question: list[np.ndarray]
    answer: list[np.ndarray]
    context: list[np.ndarray]  # of a short answer with the words before it
    fold: bool  # items of words, or of punctuation only

    @property
    def n_blocks(self) -> int:
        return -(-len(self.owner) // BLOCK)


def build_index(items: list[tuple[int, str]], fold: bool = True) -> Index:
    """The index of the items that have words, or of those of punctuation only without ``fold``."""
    owner, parts, question, answer, context = [], [], [], [], []
    for item_id, text in sorted((i, t) for i, t in items if i is not None and t and t.strip()):
        if _has_words(text) != fold:
            continue
        h = _hashes(text, fold)
        q, a = (_hashes(x, fold) for x in split_item(text))
        q, a, c = _grams(q), _grams(a), _with_context(h, a)
        for at in range(0, len(h), HALF):
            if at and len(h) - at < HALF // 2:
                break
            owner.append(item_id)
            parts.append(h[at : at + HALF] if len(h) - at >= HALF + HALF // 2 else h[at : at + HALF + HALF // 2])
            question.append(q)
            answer.append(a)
            context.append(c)
    sizes = np.array([len(p) for p in parts], float)
    n = len(parts)
    pair_item = np.repeat(np.arange(n), sizes.astype(int))
    terms, of = np.unique(np.concatenate(parts) if parts else np.zeros(0, np.uint64), return_inverse=True)
    key, tf = np.unique(of * max(n, 1) + pair_item, return_counts=True)
    term, item = key // max(n, 1), key % max(n, 1)
    df = np.bincount(term, minlength=len(terms))
    idf = np.log1p((n - df + 0.5) / (df + 0.5))
    mean = sizes.mean() if n else 1.0
    impact = idf[term] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * sizes[item] / mean))
    impact = impact / np.bincount(item, impact, n)[item]
    highest = np.zeros(len(terms))
    np.maximum.at(highest, term, impact)
    n_blocks = max(1, -(-n // BLOCK))
    bkey, bof = np.unique(term * n_blocks + item // BLOCK, return_inverse=True)
    block_high = np.zeros(len(bkey))
    np.maximum.at(block_high, bof, impact)
    known = np.zeros(2**20, bool)
    known[(terms >> np.uint64(44)).astype(np.int64)] = True
    starts = np.searchsorted(term, np.arange(len(terms) + 1))
    return Index(
        terms, known, starts, item, impact, highest,
        np.searchsorted(bkey // n_blocks, np.arange(len(terms) + 1)), bkey % n_blocks, block_high,
        np.array(owner, np.int64), question, answer, context, fold,
    )


def _expand(start: np.ndarray, term: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each entry its postings: (entry, posting)."""
    n = start[term + 1] - start[term]
    entry = np.repeat(np.arange(len(term)), n)
    return entry, np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(start[term], n)


def retrieve(index: Index, words: Words, threshold: float) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, first word in the text, indexed part, score) of all passages at or above the threshold."""
    none = tuple(np.zeros(0, np.int64) for _ in range(3)) + (np.zeros(0),)
    if not len(index.terms) or not len(words.hash):
        return none
    sizes = np.diff(words.bounds)
    cells = np.maximum(1, -(-sizes // HALF))
    base = np.cumsum(cells) - cells
    hit = np.flatnonzero(index.filter[(words.hash >> np.uint64(44)).astype(np.int64)])
    t = np.minimum(np.searchsorted(index.terms, words.hash[hit]), len(index.terms) - 1)
    same = index.terms[t] == words.hash[hit]
    hit, t = hit[same], t[same]
    doc = np.searchsorted(words.bounds, hit, "right") - 1
    cell = base[doc] + (hit - words.bounds[doc]) // HALF
    v = len(index.terms)
    # passage p is the cells p and p + 1 of a text
    first = cell > base[doc]
    key = np.unique(np.concatenate([cell * v + t, (cell[first] - 1) * v + t[first]]))
    passage, t = key // v, key % v
    bound = np.bincount(passage, index.highest[t], cells.sum())
    live = bound[passage] >= threshold
    passage, t = passage[live], t[live]
    entry, at = _expand(index.block_start, t)
    nb = index.n_blocks
    pair, of = np.unique(passage[entry] * nb + index.block[at], return_inverse=True)
    open_pair = np.bincount(of, index.block_high[at], len(pair)) >= threshold
    pair = pair[open_pair]
    if not len(pair):
        return none
    few = np.isin(passage, pair // nb)
    passage, t = passage[few], t[few]
    entry, at = _expand(index.start, t)
    item = index.item[at]
    ok = np.isin(passage[entry] * nb + item // BLOCK, pair)
    n = len(index.owner)
    found, of = np.unique(passage[entry][ok] * n + item[ok], return_inverse=True)
    score = np.bincount(of, index.impact[at][ok], len(found))
    keep = score >= threshold
    found, score = found[keep], score[keep]
    passage, item = found // n, found % n
    doc = np.searchsorted(base, passage, "right") - 1
    return doc, (passage - base[doc]) * HALF, item, score


def _hits(index: Index, piece: Piece, ids: list, threshold: float, question: float, answer: float) -> list[tuple]:
    words = words_of(folded(piece) if index.fold else piece)
    best: dict[tuple, tuple] = {}
    for doc, start, item, score in zip(*(x.tolist() for x in retrieve(index, words, threshold)), strict=True):
        lo, hi = words.bounds[doc], words.bounds[doc + 1]
        q, a, c = index.question[item], index.answer[item], index.context[item]
        reach = len(q) + len(a) + HALF
        near = _grams_all(words.hash[max(lo, lo + start - reach) : min(hi, lo + start + 2 * HALF + reach)])
        q_part, a_part = (float(np.isin(x, near).mean()) if len(x) else 1.0 for x in (q, a))
        if len(c):
            a_part = max(a_part, float(np.isin(c, near).mean()))
        if q_part >= question and a_part >= answer:
            key = (doc, int(index.owner[item]))
            row = (score, -start, q_part, a_part)
            best[key] = max(best.get(key, row), row)
    return [(ids[d], i, -s, sc, q, a) for (d, i), (sc, s, q, a) in sorted(best.items())]


def _grams_all(h: np.ndarray) -> np.ndarray:
    """Trigrams of the words, and shorter ones, as a short question or answer is kept as one gram."""
    out = [combine(*(h[i : len(h) - n + 1 + i] for i in range(n))) for n in (1, 2, 3) if len(h) >= n]
    return np.concatenate(out) if out else h


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    *,
    threshold: float = 0.5,
    question: float = 0.6,
    answer: float = 0.5,
    shard_items: int = 20_000,
) -> DataFrame:
    """One row per text and test item that it holds, with the best passage."""
    spark = docs.sparkSession
    items = benchmark.select(F.col("item_id").cast("bigint"), "text").where("text is not null")
    shards = max(1, -(-items.count() // shard_items))
    out = None
    for s in range(shards):
        part = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(shards)) == s).collect()  # about shard_items rows
        both = [build_index([(r[0], r[1]) for r in part], fold) for fold in (True, False)]
        shared = spark.sparkContext.broadcast([x for x in both if len(x.owner)])

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            names = [c.split()[0] for c in HITS.split(", ")]
            kinds = [pa.int64() if " bigint" in c else pa.float64() for c in HITS.split(", ")]
            for piece in pieces(batches):
                ids = piece.batch.column(0).to_pylist()
                rows = [r for index in shared.value for r in _hits(index, piece, ids, threshold, question, answer)]
                if rows:
                    cols = [pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)]
                    yield pa.RecordBatch.from_arrays(cols, names=names)

        hits = docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(run, HITS)
        out = hits if out is None else out.unionByName(hits)
    return out


def decontaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The documents that hold no test item. Rows without an id are kept if none of them holds one."""
    hits = contaminated(docs, benchmark, **options).select("doc_id").distinct()
    return docs.join(hits, docs["doc_id"].eqNullSafe(hits["doc_id"]), "left_anti")
