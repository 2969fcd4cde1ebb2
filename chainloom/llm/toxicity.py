"""Toxicity: a support vector machine on a gapped subsequence string kernel, with Nyström landmarks.

The kernel of two strings sums, over all three-letter subsequences that both hold within a span of
``SPAN`` bytes, decay**(span in one + span in the other), normalised to 1 for equal strings; so extra
characters in a word lower it a little and do not hide the word. Strings are words in lower case; single
letters in a row count as one word, marks and digits inside a word are left out, and words over ``LONG`` bytes as overlapping parts. A sentence's value at a
landmark is the highest over its words, and Nyström's map of these values is what the machine sees.

Labels belong to documents, the machine to sentences: training goes round by round, a toxic document
being represented by the sentence that scores highest so far. A document's score is the calibrated
decision of its highest sentence and the sum of what its sentences add.

Edge cases: null and empty texts have no word and get the score of a text without any known word; very
long texts are read whole; equal texts get equal scores; missing labels are not learned from; without a
toxic sample, nothing is toxic. Empty tables give no rows. ``score`` of the input is replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, types as T

from chainloom.llm.common import _LOWER_CODES, INVERSE, Piece, combine, mix64, pieces, powers, prefix_hashes, words_of

SPAN, DECAY, LONG, FLOOR = 6, 0.7, 32, 0.45
SYMBOLS = 44
_CODE = np.full(256, 27, np.int32)  # digits, marks and blanks are one symbol
_CODE[97:123] = np.arange(1, 27)
_CODE[65:91] = np.arange(1, 27)
_CODE[128:] = 28 + (np.arange(128, 256) & 15)
_STOP = np.zeros(256, bool)
_STOP[[0x0A, 0x21, 0x2E, 0x3F]] = True


@dataclass
class Units:
    """Distinct words of a piece with their bytes, and each occurrence's word, sentence and text."""

    data: np.ndarray
    begin: np.ndarray
    end: np.ndarray
    of: np.ndarray
    sentence: np.ndarray
    doc: np.ndarray
    n_docs: int


def units_of(piece: Piece) -> Units:
    w = words_of(piece)
    begin, end, doc = w.begin, w.end, w.doc()
    single = end - begin == 1
    glue = np.zeros(len(begin), bool)
    glue[1:] = single[1:] & single[:-1] & (doc[1:] == doc[:-1])
    first = np.flatnonzero(~glue)
    last = np.append(first[1:], len(begin)) - 1 if len(first) else first
    begin, end, doc = begin[first], end[last], doc[first]
    sentence = np.cumsum(_STOP[piece.data], dtype=np.int64)[begin] if len(begin) else begin
    # marks, digits and blanks inside a word are left out
    letter = _CODE[piece.data] != 27
    before = np.append(0, np.cumsum(letter))
    data, begin, end = piece.data[letter], before[begin], before[end]
    n = np.maximum(1, -(-(end - begin - LONG // 2) // (LONG // 2)))
    if (n > 1).any():
        step = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        b, e, doc, sentence = np.repeat(begin, n) + step * (LONG // 2), np.repeat(end, n), np.repeat(doc, n), np.repeat(sentence, n)
        begin, end = b, np.minimum(e, b + LONG)
    h = prefix_hashes(data, _LOWER_CODES)
    h = mix64((h[end] - h[begin]) * powers(INVERSE, len(data) + 1)[begin] + (end - begin).astype(np.uint64))
    _, at, of = np.unique(h, return_index=True, return_inverse=True)
    return Units(data, begin[at], end[at], of, sentence, doc, len(piece))


def _steps(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, float]]:
    """(word, subsequence) of every occurrence and their common decayed weight, by the two steps between letters."""
    size = end - begin
    unit = np.repeat(np.arange(len(begin), dtype=np.int32), size)
    at = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + np.repeat(begin, size)
    left = np.repeat(end, size) - at
    code = np.append(_CODE[data[at]], np.zeros(SPAN, np.int32))
    for b in range(2, SPAN):
        p = np.flatnonzero(left > b)
        u, ends = unit[p], code[p] * (SYMBOLS * SYMBOLS) + code[p + b]
        for a in range(1, b):
            yield u, ends + code[p + a] * SYMBOLS, DECAY ** (b + 1)


def subsequences(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word, subsequence, decayed weight) of every occurrence, ordered by word."""
    u, s, v = (np.concatenate(x) for x in zip(*((u, s, np.full(len(u), w)) for u, s, w in _steps(data, begin, end)), strict=True))
    order = np.argsort(u, kind="stable")
    return u[order], s[order], v[order]


def gathered(u: np.ndarray, s: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Weights added up by word and subsequence."""
    key, of = np.unique(u * np.int64(SYMBOLS**3) + s, return_inverse=True)
    return key // SYMBOLS**3, key % SYMBOLS**3, np.bincount(of, v, len(key))


@dataclass
class ToxicModel:
    rows: np.ndarray  # row of a subsequence, -1 for those no landmark has
    start: np.ndarray  # of each row in the next two
    mark: np.ndarray  # landmarks that hold the subsequence
    value: np.ndarray  # and its part in their unit vectors
    n_marks: int
    weight: np.ndarray  # of the machine, on kernel values: Nyström's map included
    bias: float
    slope: np.ndarray
    shift: float

    def highest(self) -> np.ndarray:
        """The largest weight any landmark gives a subsequence."""
        top = np.maximum.reduceat(self.value, self.start[:-1]) if len(self.value) else np.zeros(0)
        return np.append(top, 0.0)[self.rows]

    def kernel(self, data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Words with a kernel value of FLOOR or more at a landmark, and their values (smaller ones are 0)."""
        none = np.zeros(0, np.int64), np.zeros((0, self.n_marks))
        low, bound = np.zeros(len(begin)), np.zeros(len(begin))
        highest = self.highest()
        for u, s, weight in _steps(data, begin, end):
            low += np.bincount(u, minlength=len(begin)) * weight**2  # the norm is at least the root of this
            bound += np.bincount(u, highest[s], len(begin)) * weight  # and no value above this
        near = np.flatnonzero((bound > 0) & (bound >= FLOOR * np.sqrt(low)))
        if not len(near):
            return none
        u, s, v = subsequences(data, begin[near], end[near])
        known = self.rows[s] >= 0
        row, ku, kv = self.rows[s[known]], u[known], v[known]
        n = np.diff(self.start)[row]  # landmarks that hold the subsequence: one or two mostly
        at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(self.start[row], n)
        m = self.n_marks
        k = np.bincount(np.repeat(ku, n) * m + self.mark[at], np.repeat(kv, n) * self.value[at], len(near) * m).reshape(-1, m)
        ku = np.flatnonzero(k.max(1) >= FLOOR * np.sqrt(low[near]))
        if not len(ku):
            return none
        k = k[ku]
        pick = np.zeros(len(near), bool)
        pick[ku] = True
        gu, _, gv = gathered(u[pick[u]], s[pick[u]], v[pick[u]])
        k = k / np.sqrt(np.bincount(gu, gv * gv, len(near))[ku])[:, None]
        k[k < FLOOR - 1e-9] = 0
        kept = k.any(1)
        return near[ku[kept]], k[kept]

    def sentences(self, piece: Piece) -> tuple[np.ndarray, np.ndarray]:
        """(text, kernel values) of each sentence with a value above 0."""
        u = units_of(piece)
        which, k = self.kernel(u.data, u.begin, u.end)
        row = np.full(len(u.begin), -1)
        row[which] = np.arange(len(which))
        hit = np.flatnonzero(row[u.of] >= 0) if len(u.of) else np.zeros(0, np.int64)
        if not len(hit):
            return np.zeros(0, np.int64), np.zeros((0, self.n_marks))
        hit = hit[np.argsort(u.sentence[hit], kind="stable")]
        _, first = np.unique(u.sentence[hit], return_index=True)
        return u.doc[hit][first], np.maximum.reduceat(k[row[u.of[hit]]], first, axis=0)

    def decisions(self, piece: Piece) -> np.ndarray:
        """Of each text: the decision of its highest sentence, and how far its sentences lie above -1/2 together."""
        out = np.stack([np.full(len(piece), self.bias), np.zeros(len(piece))], 1)
        doc, k = self.sentences(piece)
        d = k @ self.weight + self.bias
        np.maximum.at(out[:, 0], doc, d)
        np.add.at(out[:, 1], doc, np.clip(d + 0.5, 0, 2))
        out[:, 1] = np.log1p(out[:, 1])
        return out

    def probability(self, decision: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(decision @ self.slope + self.shift, -30, 30)))


def _as_pieces(texts: list[bytes]) -> Iterator[Piece]:
    return pieces(iter([pa.RecordBatch.from_arrays([pa.array(texts, pa.large_binary())], names=["text"])]))


def _without_copies(texts: list[bytes]) -> list[bytes]:
    """The texts, one of those with the same smallest word triple: copies would count as independent evidence."""
    out, seen = [], set()
    for piece in _as_pieces(texts):
        w = words_of(piece)
        raw = piece.data.tobytes()
        grams = combine(w.hash[:-2], w.hash[1:-1], w.hash[2:]) if len(w.hash) > 2 else w.hash
        for d, (lo, hi) in enumerate(zip(w.bounds[:-1].tolist(), w.bounds[1:].tolist(), strict=True)):
            mark = int(grams[lo : hi - 2].min()) if hi - lo > 2 else tuple(w.hash[lo:hi].tolist())
            if mark not in seen:
                seen.add(mark)
                out.append(raw[piece.starts[d] : piece.starts[d + 1] - 1])
    return out


def _landmarks(toxic: list[bytes], clean: list[bytes], n: int, n_clean: int) -> list[bytes]:
    """Words that mark toxic texts most (by smoothed log odds of texts holding them), and common clean ones."""
    counts: list[dict[bytes, int]] = []
    for texts in (toxic, clean):
        seen: dict[bytes, int] = {}
        for piece in _as_pieces(texts):
            u = units_of(piece)
            raw = u.data.tobytes()
            pairs = np.unique(u.doc * len(u.begin) + u.of) % max(len(u.begin), 1)
            for i, c in zip(*np.unique(pairs, return_counts=True), strict=True):
                word = raw[u.begin[i] : u.end[i]].lower()
                seen[word] = seen.get(word, 0) + int(c)
        counts.append(seen)
    a, b = counts
    na, nb = len(toxic) + 1, len(clean) + 1
    odds = {w: np.log((c + 0.5) / na) - np.log((b.get(w, 0) + 0.5) / nb) for w, c in a.items() if c >= 3 and len(w) >= 3}
    best = sorted((w for w in odds if odds[w] > 2), key=lambda w: (-odds[w] * np.log(a[w] + 1), w))[:n]
    common = sorted((w for w in b if len(w) >= 3 and odds.get(w, 0) < 1), key=lambda w: (-b[w], w))[:n_clean]
    return best + common


def _vectors(marks: list[bytes]) -> tuple[tuple, np.ndarray]:
    """The landmarks' unit vectors by subsequence, and their kernel matrix."""
    data = np.frombuffer(b"".join(marks), np.uint8)
    end = np.cumsum([len(m) for m in marks])
    u, s, v = gathered(*subsequences(data, end - [len(m) for m in marks], end))
    v = v / np.sqrt(np.bincount(u, v * v, len(marks)))[u]
    order = np.argsort(s, kind="stable")
    u, s, v = u[order], s[order], v[order]
    used, start, of = np.unique(s, return_index=True, return_inverse=True)
    rows = np.full(SYMBOLS**3, -1, np.int32)
    rows[used] = np.arange(len(used))
    dense = np.zeros((len(used), len(marks)))
    dense[of, u] = v
    return (rows, np.append(start, len(s)), u, v, len(marks)), dense.T @ dense


def _svm(x: np.ndarray, y: np.ndarray, cost: np.ndarray, ridge: float, steps: int = 400) -> tuple[np.ndarray, float]:
    """Squared hinge loss by Newton steps on the rows inside the margin."""
    f = np.c_[x, np.ones(len(x))]
    w = np.zeros(f.shape[1])
    reg = ridge * np.eye(len(w))
    reg[-1, -1] = 1e-6
    for _ in range(steps):
        inside = y * (f @ w) < 1
        g = f[inside] * cost[inside][:, None]
        new = np.linalg.solve(g.T @ f[inside] + reg, g.T @ y[inside])
        if np.allclose(new, w, atol=1e-7):
            break
        w = 0.5 * w + 0.5 * new
    return w[:-1], float(w[-1])


def fit(toxic: list[bytes], clean: list[bytes], *, landmarks: int = 64, clean_landmarks: int = 8, ridge: float = 0.1, rounds: int = 4):
    """Landmarks and machine from three quarters of the samples, the calibration from the rest."""
    toxic, clean = _without_copies(toxic), _without_copies(clean)
    held_t, held_c = toxic[::4], clean[::4]
    toxic, clean = [t for i, t in enumerate(toxic) if i % 4], [t for i, t in enumerate(clean) if i % 4]
    marks = _landmarks(toxic, clean, landmarks, clean_landmarks) or [b"aaa"]
    vectors_of, k_ll = _vectors(marks)
    values, vectors = np.linalg.eigh(k_ll)
    root = vectors @ np.diag(1 / np.sqrt(np.maximum(values, 1e-3))) @ vectors.T
    model = ToxicModel(*vectors_of, np.zeros(len(marks)), 0.0, np.ones(2), 0.0)

    def bags(texts):
        xs, docs, base = [np.zeros((0, len(marks)))], [np.zeros(0, np.int64)], 0
        for piece in _as_pieces(texts):
            d, k = model.sentences(piece)
            docs.append(d + base)
            xs.append(k)
            base += len(piece)
        return np.concatenate(docs), np.concatenate(xs) @ root

    dt, xt = bags(toxic)
    _, xc = bags(clean)
    if not len(xt):
        return ToxicModel(*vectors_of, np.zeros(len(marks)), -1.0, np.ones(2), -4.0)
    zero = np.zeros((1, len(marks)))
    decision = xt @ root.sum(1)  # at first: the sentence nearest to the landmarks
    for _ in range(rounds):
        order = np.lexsort((-decision, dt))
        top = order[np.unique(dt[order], return_index=True)[1]]
        x = np.concatenate([xt[top], xc, zero])
        y = np.concatenate([np.ones(len(top)), -np.ones(len(xc) + 1)])
        cost = np.concatenate([np.ones(len(top)), np.full(len(xc), min(1.0, len(top) / max(len(xc), 1))), [len(top)]])
        w, b = _svm(x, y, cost, ridge)
        decision = xt @ w + b
    model.weight, model.bias = root @ w, b
    d = [np.concatenate([model.decisions(p) for p in _as_pieces(t)] or [np.zeros((0, 2))]) for t in (held_t, held_c)]
    x, y = np.concatenate(d), np.concatenate([np.ones(len(d[0])), np.zeros(len(d[1]))])
    f, w = np.c_[x, np.ones(len(x))], np.array([2.0, 1.0, 0.0])
    if len(d[0]) and len(d[1]):
        for _ in range(50):
            p = 1 / (1 + np.exp(-np.clip(f @ w, -30, 30)))
            ridge_m = np.diag([0.05, 0.05, 1e-3])
            step = np.linalg.solve(f.T @ (f * (p * (1 - p))[:, None]) + ridge_m, f.T @ (p - y) + ridge_m @ w)
            w -= step * min(1.0, 2.0 / max(np.abs(step).max(), 1e-12))
    model.slope, model.shift = w[:2], float(w[2])
    return model


def train(docs: DataFrame, labels: DataFrame, *, where=None, toxic_rows: int = 2000, clean_rows: int = 3000, text_bytes: int = 16_384):
    """Fit on at most ``toxic_rows`` and ``clean_rows`` labelled texts, ``text_bytes`` of each (80 MB at most)."""
    from chainloom.llm.quality import sample

    return fit(
        sample(docs, labels, "toxic", 1, toxic_rows, text_bytes, where),
        sample(docs, labels, "toxic", 0, clean_rows, text_bytes, where),
    )


def score(docs: DataFrame, model: ToxicModel) -> DataFrame:
    """The documents with ``score``: the chance, 0 to 1, that a text is toxic."""
    docs = docs.drop("score")
    kind = T.StructType([*docs.schema.fields, T.StructField("score", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches):
            p = pa.array(model.probability(model.decisions(piece)))
            yield pa.RecordBatch.from_arrays([*piece.batch.columns, p], names=[*piece.batch.schema.names, "score"])

    return docs.mapInArrow(run, kind)
