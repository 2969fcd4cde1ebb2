"""Quality classifier by compression: one zstandard dictionary from good, one from bad labelled text.

A text is compressed in pieces with either dictionary. The difference of the two sizes over the larger
one says which side it is closer to; logistic regression on it (with the two ratios and the length,
which say how far it can be trusted) gives the score. The fit runs on a bounded sample of labelled rows.

Edge cases: null and empty texts get the score of an empty text; texts of any length are scored whole;
rows of the same text get the same score; missing labels are not learned from; with labels of one class
only the score is that class's share. Empty tables give no rows. Other columns are kept untouched, but
``score`` is replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard as zstd
from pyspark.sql import DataFrame, functions as F, types as T

PIECE = 4096


@dataclass
class QualityModel:
    good: bytes
    bad: bytes
    mean: np.ndarray
    scale: np.ndarray
    weight: np.ndarray
    level: int = 3

    def sizer(self):
        return _Sizer(self.good, self.bad, self.level)


class _Sizer:
    def __init__(self, good: bytes, bad: bytes, level: int):
        flags = {"write_content_size": False, "write_checksum": False, "write_dict_id": False}
        self.good, self.bad = (
            zstd.ZstdCompressor(level=level, dict_data=zstd.ZstdCompressionDict(d), **flags) for d in (good, bad)
        )

    def features(self, text: bytes) -> tuple[float, ...]:
        g = b = 0
        for i in range(0, max(len(text), 1), PIECE):
            part = text[i : i + PIECE]
            g += len(self.good.compress(part))
            b += len(self.bad.compress(part))
        n = len(text) + 1
        diff, size = (b - g) / max(g, b), np.log(n)
        return diff, g / n, b / n, size, diff * diff, diff * g / n, diff * size


def fit(good: list[bytes], bad: list[bytes], *, dictionary_bytes: int = 112_640, level: int = 3, ridge: float = 0.05):
    """Dictionaries from one half of the samples, the calibration from the other half."""

    def dictionary(texts: list[bytes]) -> bytes:
        parts = [t[i : i + 2048] for t in texts for i in range(0, len(t), 2048)]
        try:
            return zstd.train_dictionary(dictionary_bytes, parts).as_bytes()
        except zstd.ZstdError:  # too little text to train on: the text itself serves as dictionary
            return b"".join(parts)[-dictionary_bytes:] or b" " * 8

    raw_good, raw_bad = dictionary(good[::2]), dictionary(bad[::2])
    sizer = _Sizer(raw_good, raw_bad, level)
    held = [(t, 1.0) for t in good[1::2]] + [(t, 0.0) for t in bad[1::2]]
    x = np.array([sizer.features(t) for t, _ in held]).reshape(-1, 7)
    y = np.array([v for _, v in held])
    mean, scale = (x.mean(0), x.std(0) + 1e-9) if len(x) else (np.zeros(7), np.ones(7))
    f = np.c_[(x - mean) / scale, np.ones(len(x))]
    w = np.zeros(8)
    if len(set(y)) < 2:
        n_good, n_bad = len(good), len(bad)
        w[-1] = np.log((n_good + 0.5) / (n_bad + 0.5))
        return QualityModel(raw_good, raw_bad, mean, scale, w, level)
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(f @ w, -30, 30)))
        h = f.T @ (f * (p * (1 - p))[:, None]) + ridge * np.eye(8)
        step = np.linalg.solve(h, f.T @ (p - y) + ridge * w)
        w -= step * min(1.0, 2.0 / max(np.abs(step).max(), 1e-12))
    return QualityModel(raw_good, raw_bad, mean, scale, w, level)


def sample(docs: DataFrame, labels: DataFrame, column: str, value: int, rows: int, text_bytes: int, where=None) -> list[bytes]:
    """Texts of at most ``rows`` rows with this label, those with the smallest id hashes.

    The ids are chosen among the labels alone; only they (a bounded list) meet the documents. Of a longer
    text the middle ``text_bytes`` bytes are learned from.
    """
    picked = labels.where(F.col(column) == value).select("doc_id")
    if where is not None:
        picked = picked.where(where)
    picked = picked.where("doc_id is not null").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    raw = F.encode("text", "UTF-8")
    start = F.greatest(F.lit(1), F.expr(f"cast((octet_length(text) - {text_bytes}) / 2 as int)"))
    found = (
        docs.select("doc_id", "text")
        .where("text is not null")
        .join(F.broadcast(picked), "doc_id")
        .select("doc_id", F.substring(raw, start, F.lit(text_bytes)).alias("t"))
    )
    return [bytes(r[1]) for r in sorted(found.collect(), key=lambda r: (r[0], bytes(r[1])))]


def train(docs: DataFrame, labels: DataFrame, *, where=None, rows: int = 3000, text_bytes: int = 16_384) -> QualityModel:
    """Fit on at most ``rows`` labelled texts of each class, ``text_bytes`` of each (about 50 MB at most a class)."""
    good = sample(docs, labels, "quality", 1, rows, text_bytes, where)
    bad = sample(docs, labels, "quality", 0, rows, text_bytes, where)
    return fit(good, bad)


def score(docs: DataFrame, model: QualityModel) -> DataFrame:
    """The documents with ``score``: the chance, 0 to 1, that a text is of good quality."""
    docs = docs.drop("score")
    at = docs.columns.index("text")
    kind = T.StructType([*docs.schema.fields, T.StructField("score", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sizer = model.sizer()
        for batch in batches:
            for begin in range(0, batch.num_rows, 512):
                part = batch.slice(begin, 512)
                texts = part.column(at).cast(pa.large_binary())
                x = np.array([sizer.features(t.as_py() or b"") for t in texts]).reshape(-1, 7)
                f = np.c_[(x - model.mean) / model.scale, np.ones(len(x))]
                p = 1 / (1 + np.exp(-np.clip(f @ model.weight, -30, 30)))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(p)], names=[*part.schema.names, "score"])

    return docs.mapInArrow(run, kind)
