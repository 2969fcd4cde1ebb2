"""Cross-tokenizer alignment against a walk along both token sequences with the files' own encoders."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
import sentencepiece
from tokenizers import Tokenizer

from chainloom.llm import alignment, queries

WIDE = "doc_id bigint, text string, n_a string, block string, pairs int, docs string, number int"


def plain(texts):
    """(doc row number -> expected row), by brute force."""
    first = Tokenizer.from_file(alignment.FIRST)
    first.encode_special_tokens = True
    second = sentencepiece.SentencePieceProcessor(model_file=alignment.SECOND)
    letters = alignment._byte_letters()
    infos, counts = [], Counter()
    for text in texts:
        infos.append(None)
        if not text:
            continue
        a, b = first.encode(" " + text, add_special_tokens=False).ids, second.encode(text)
        bytes_a = [bytes(letters[c] for c in first.id_to_token(i)) for i in a]
        names = [second.id_to_piece(i) for i in b]
        bytes_b = [bytes([int(p[3:5], 16)]) if second.is_byte(i) else p.replace("▁", " ").encode() for i, p in zip(b, names, strict=True)]
        want = (" " + text).encode()
        if b"".join(bytes_a) != want or b"".join(bytes_b) != want:
            continue
        ends_a, ends_b = (np.cumsum([len(x) for x in xs]).tolist() for xs in (bytes_a, bytes_b))
        groups, i, j = [], 0, 0
        for cut in sorted(set(ends_a) & set(ends_b)):
            k, m = ends_a.index(cut, i) + 1, ends_b.index(cut, j) + 1
            groups.append((a[i:k], b[j:m]))
            i, j = k, m
        links = Counter((x, y) for g in groups for x in g[0] for y in g[1])
        shown = ";".join(",".join(map(str, g[0])) + "|" + ",".join(map(str, g[1])) for g in groups)
        infos[-1] = (len(a), len(b), len(groups), links, hashlib.sha256(shown.encode()).hexdigest())
        counts.update(links.keys())
    highest: dict[int, int] = {}
    for (x, _), n in counts.items():
        highest[x] = max(n, highest.get(x, 0))
    out = []
    for info in infos:
        if info is None:
            out.append((0, 0, 0, 0, 0, 0, ""))
            continue
        n_a, n_b, n_groups, links, digest = info
        best = sum(n for (x, y), n in links.items() if counts[x, y] == highest[x])
        out.append((n_a, n_b, n_groups, sum(links.values()), best, sum(n * counts[p] for p, n in links.items()), digest))
    return out


COLUMNS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def edge_texts():
    rng = random.Random(3)
    odd = "aZé漢字😀ſ\t\n ​　ßØ0٣<|>_-'’"
    texts = ["".join(rng.choice(odd) for _ in range(rng.randint(1, 120))) for _ in range(40)]
    texts += ["I'll say: it's 3,000 — naïve café\n\n\tdone  ", "<|endoftext|><s></s><unk><0x41>", "a▁b", "a\x00b", " " * 300 + "x"]
    return texts + ["word " * 500, None, "", "word " * 500, " " * 6_000 + "tail"]


@pytest.mark.parametrize("blocks", [{}, {"block_bytes": 900}, {"block_pairs": 40}])
def test_alignment_equals_walk(spark, blocks):
    texts = edge_texts()
    docs = spark.createDataFrame([(i // 2 if i < 9 else i, t, "n", "b", 1, "d", 2) for i, t in enumerate(texts)], WIDE)
    out = alignment.align(docs.repartition(3), **blocks).collect()
    ids = [i // 2 if i < 9 else i for i in range(len(texts))]
    want = sorted((i, *row) for i, row in zip(ids, plain(texts), strict=True))
    assert sorted((r.doc_id, *(r[c] for c in COLUMNS)) for r in out) == want


def test_links_of_large_groups(monkeypatch):
    """Groups by distinct ids give the links that all pairs give."""
    rng = np.random.default_rng(1)
    a, b = rng.integers(0, 5, 60), rng.integers(0, 4, 45)
    group_a, group_b = np.sort(rng.integers(0, 3, 60)), np.sort(rng.integers(0, 3, 45))
    per_a, per_b = np.bincount(group_a, minlength=3), np.bincount(group_b, minlength=3)
    want = Counter((int(x), int(y)) for g in range(3) for x in a[group_a == g] for y in b[group_b == g])
    for large, chunk in ((10**9, 7), (1, 3), (1, 10**6)):
        monkeypatch.setattr(alignment, "_LARGE", large)
        monkeypatch.setattr(alignment, "_CHUNK", chunk)
        keys, times = alignment._links(a, b, group_a, per_a, per_b, np.cumsum(per_b) - per_b, np.zeros(3, int), 10, 100)
        assert {(k // 10, k % 10): n for k, n in zip(keys.tolist(), times.tolist(), strict=True)} == want


def test_fast_encoder_gives_the_ids_of_the_file(spark, sf_dir):
    tokenizer = alignment._tokenizers(tuple(open(p, "rb").read() for p in (alignment.FIRST, alignment.SECOND)))[0]
    assert tokenizer.fast is not None
    texts = [r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("text").collect() if r.text]
    for text in texts + [t for t in edge_texts() if t]:
        assert tokenizer.encode(text).tolist() == tokenizer.slow.encode(" " + text, add_special_tokens=False).ids


def test_alignment_query_and_empty_table(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    want = sorted((r.doc_id, *w) for r, w in zip(rows, plain([r.text for r in rows]), strict=True))
    out = queries.QUERIES["op13_tokenizer_alignment"](spark, sf_dir)
    assert sorted((r.doc_id, *(r[c] for c in COLUMNS)) for r in out.collect()) == want
    assert alignment.align(spark.createDataFrame([], "doc_id bigint, text string")).columns == out.columns
    assert alignment.align(spark.createDataFrame([], "doc_id bigint, text string")).count() == 0
