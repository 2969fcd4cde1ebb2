"""Text operators against SQL, brute force and held-out labels; every edge case on a small table."""

from __future__ import annotations

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from chainloom.llm import chat, contamination, jaccard, licences, lines, mixing, quality, queries, repeats, topk, toxicity
from tests.compare import difference, duck

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, score double, n_lines int, block string, slot int"


def make_docs(spark, rows):
    """Documents with columns that clash with those the operators add."""
    return spark.createDataFrame([(i, t, "en", s, None, -1.0, -1, "x", -1) for i, t, s in rows], DOCS)


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(5)
    words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 6))) for _ in range(300)]
    line = lambda n: " ".join(rng.choice(words) for _ in range(n))
    base = [line(60), "\n".join(line(12) for _ in range(8)), line(900), line(3), "x" * 400]
    rows = []
    for i in range(60):
        t = rng.choice(base)
        w = t.split(" ")
        for _ in range(rng.choice((0, 0, 1, 2, 5))):
            w[rng.randrange(len(w))] = rng.choice(words)
        rows.append((i * 3 % 61, " ".join(w), rng.choice(("src0", "src1", "zzz", None))))
    rows += [(70, None, "src0"), (71, "", None), (72, "one", "src0"), (73, "one", "src9"), (74, "two words", "src0")]
    rows += [(75, line(40) + "\n" + base[0] + " tail", "src1"), (75, None, "src1"), (None, base[0], "src2"), (76, line(20_000), "src2")]
    return rows + [rows[0], rows[0]]


@pytest.fixture(scope="module")
def docs(spark, texts):
    return make_docs(spark, texts).cache()


@pytest.fixture(scope="module")
def no_docs(spark):
    return make_docs(spark, [])


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_sql(spark, sf_dir, name):
    assert difference(spark, duck(sf_dir), name, queries.QUERIES[name], queries.ORACLES[name], sf_dir) is None


def shingles(text, size):
    w = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").split()
    return {tuple(w[i : i + size]) for i in range(len(w) - size + 1)} if len(w) >= size else {tuple(w)} - {()}


@pytest.mark.parametrize(("size", "num", "den"), [(3, 90, 100), (5, 8, 10), (2, 6, 10)])
def test_jaccard_against_brute_force(docs, texts, size, num, den):
    got = {(r["doc_id"], r["n_shingles"]): r["component_id"] for r in jaccard.jaccard_join(docs, size=size, num=num, den=den).collect()}
    sets = [(i, frozenset(shingles(t, size))) for i, t, _ in texts]
    up = list(range(len(sets)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a in range(len(sets)):
        for b in range(a):
            x, y = sets[a][1], sets[b][1]
            if x and y and den * len(x & y) >= num * len(x | y):
                up[find(a)] = find(b)
    for k, (i, s) in enumerate(sets):
        same = [sets[j][0] for j in range(len(sets)) if find(j) == find(k) and sets[j][0] is not None]
        assert got[(i, len(s))] == (min(same) if s and same else i)


def test_jaccard_of_nothing(no_docs):
    assert jaccard.jaccard_join(no_docs).count() == 0


def test_flips_join_a_group_of_far_copies(spark):
    """Copies that differ from their leader by more than the threshold are still joined with each other."""
    rng = random.Random(1)
    base = [f"w{rng.randrange(10**6)}" for _ in range(200)]
    far = list(base)
    for i in range(0, 60, 6):
        far[i] = f"y{i}"
    rows = [(0, " ".join(base), "s")]
    for k in range(1, 300):
        w = list(far if k % 2 else base)
        w[100 + k % 90] = f"z{k}"
        rows.append((k, " ".join(w), "s"))
    out = {r[0]: r[1] for r in jaccard.jaccard_join(make_docs(spark, rows), size=3, num=90, den=100).select("doc_id", "component_id").collect()}
    assert {out[k] for k in range(0, 300, 2)} == {0}
    assert {out[k] for k in range(1, 300, 2)} == {1}


def test_passage_of_many_documents_makes_no_long_lists(spark, monkeypatch):
    """A passage that all documents share stays out of the index as long as their other words fill it."""
    rng = random.Random(3)
    passage = [f"p{i}" for i in range(60)]
    rows = [(k, " ".join([f"w{rng.randrange(10**9)}" for _ in range(rng.randint(90, 130))] + passage), "s") for k in range(200)]
    rows.append((200, rows[7][1] + " tail", "s"))
    lists, keep = [], jaccard.stored
    monkeypatch.setattr(jaccard, "stored", lambda df, purpose: lists.append(keep(df, purpose)) or lists[-1] if purpose == "jaccard-lists" else keep(df, purpose))
    out = {r[0]: r[1] for r in jaccard.jaccard_join(make_docs(spark, rows), size=3, num=9, den=10).select("doc_id", "component_id").collect()}
    assert out == {k: 7 if k == 200 else k for k in range(201)}
    assert lists[0].groupBy("t").agg(F.countDistinct("cid").alias("k")).agg(F.max("k")).first()[0] < 48


def test_prefixes_by_a_new_order_come_from_heads(spark, monkeypatch):
    """A prefix by another order is the one of the whole set, be it taken from the head or, where that is too short, from the text."""
    import numpy as np
    import pyarrow as pa

    rng = random.Random(4)
    rows = [(k, " ".join(f"w{rng.randrange(300)}" for _ in range(rng.choice([2, 3, 9, 40, 200, 700]))), "s") for k in range(80)]
    rows += [(None, "a b c d e", "s"), (90, None, "s"), (91, "", "s")]
    df = make_docs(spark, rows)
    num, den = 9, 10
    piece = next(jaccard.pieces([pa.record_batch({"text": pa.array([t for _, t, _ in rows], pa.string())})]))
    sets = {r[0]: s for r, s in zip(rows, jaccard.shingle_sets(piece, 1), strict=True)}
    held = sorted({int(x) for s in sets.values() for x in s})
    first = jaccard._sets(df, 1, num, den)
    classes = first.where("n > 0").select("n", "d1", "d2", F.col("doc_id").alias("doc_min"), F.col("th").alias("th_min"), F.coalesce("doc_id", F.lit(-1)).alias("cid"))
    reps = jaccard.stored(jaccard._representatives(first, classes), "reps")

    def by_hand(s, last):
        s = sorted(int(x) for x in s)
        k = min(len(s), len(s) - -(-num * len(s) // den) + 1 + min(4, len(s) // 40))
        return ([x for x in s if x not in last] + [x for x in s if x in last])[:k]

    marks, keep = [], jaccard.marked
    monkeypatch.setattr(jaccard, "marked", lambda *a: marks.append(1) or keep(*a))
    for share in (0.0, 0.3, 0.8):
        heavy = np.array([x for x in held if rng.random() < share], np.uint64)
        got = {r["cid"]: [x % 2**64 for x in r["prefix"]] for r in jaccard._prefixes(df, reps, 1, num, den, heavy).collect()}
        assert got == {-1 if i is None else i: by_hand(s, set(heavy.tolist())) for i, s in sets.items() if len(s)}
        new = np.setdiff1d(np.array([x for x in held if rng.random() < 0.02], np.uint64), heavy)
        got = {r["cid"]: [x % 2**64 for x in r["prefix"]] for r in jaccard._prefixes(df, reps, 1, num, den, heavy, new).collect()}
        before = {i: by_hand(s, set(heavy.tolist())) for i, s in sets.items()}
        both = set(heavy.tolist()) | set(new.tolist())
        assert got == {-1 if i is None else i: by_hand(sets[i], both) for i, was in before.items() if set(was) & set(new.tolist())}
    assert marks  # the last order put more than half of some heads last


def test_entries_that_can_meet_none_are_not_listed(spark, monkeypatch):
    """Texts that share words, but differ too much in size or share them too late in both prefixes, make no index lists."""
    rng = random.Random(5)
    words = [f"w{rng.randrange(10**9)}" for _ in range(900)]
    rows = [(k, " ".join(words[: 100 * 3**k]), "s") for k in range(3)]
    rows += [(10, " ".join(words[:20] + ["x", "y", "z"]), "s"), (11, " ".join(words[:20] + ["x", "y", "z", "x2"]), "s")]
    lists, keep = [], jaccard.stored
    monkeypatch.setattr(jaccard, "stored", lambda df, purpose: lists.append(keep(df, purpose)) or lists[-1] if purpose == "jaccard-lists" else keep(df, purpose))
    out = {r[0]: r[1] for r in jaccard.jaccard_join(make_docs(spark, rows), size=3, num=9, den=10).select("doc_id", "component_id").collect()}
    assert out == {0: 0, 1: 1, 2: 2, 10: 10, 11: 10}
    ids = jaccard._sets(make_docs(spark, rows), 3, 9, 10)
    assert {r["n"] for r in lists[0].select("n").distinct().collect()} <= {r["n"] for r in ids.where("doc_id >= 10").select("n").collect()}


def test_top_k_edges(spark):
    kind = "vec_id bigint, embedding array<float>, score int"
    nan, inf = float("nan"), float("inf")
    rows = [(0, [0.5, 0.5], 1), (50, None, 1), (100, [nan, 1.0], 1), (1, [0.5, 0.5], 1), (2, [0.5, 0.5], 1), (3, [None, 1.0], 1)]
    rows += [(4, [-0.1, -3.0], 1), (5, [inf, 0.0], 1), (150, [], 1), (None, [1.0, 1.0], 1)]
    got = topk.top_k(spark.createDataFrame(rows, kind), F.col("vec_id") % 50 == 0, k=3).orderBy("query_id", "rank").collect()
    assert [tuple(r) for r in got] == [(0, 1, 1, 32768), (0, 2, 2, 32768), (0, 3, 4, 128 * -26 + 128 * -768)]
    assert topk.top_k(spark.createDataFrame([], kind), F.lit(True)).count() == 0


def test_top_k_against_brute_force(spark):
    rng = random.Random(2)
    rows = [(i, [rng.gauss(i % 4, 0.4) for _ in range(6)]) for i in range(400)]
    got = topk.top_k(spark.createDataFrame(rows, "vec_id bigint, embedding array<float>"), F.col("vec_id") % 20 == 0, block=37, chunk=7)
    import numpy as np

    v = np.floor(256 * np.array([r[1] for r in rows], np.float32).astype(float)).astype(int)
    want = []
    for q in range(0, 400, 20):
        s = sorted((-(int(v[q] @ v[c])), c) for c in range(400) if c != q)[:5]
        want += [(q, r + 1, c, -x) for r, (x, c) in enumerate(s)]
    assert sorted(tuple(r) for r in got.collect()) == want


def test_chat_edges(spark):
    kind = "conv_id bigint, turn bigint, role string, text string, loss int"
    rows = [
        (1, 0, "user", "a\\<\\|b <|im_end|>\n<|im_start|>x", 1), (1, 1, "assistant", None, 1), (1, 2, None, "n", 1),
        (2, None, "system", "s", 1), (2, 1, "user", "u", 1), (2, 1, "user", "u", 1), (3, 0, "us\ner\\", "", 1), (None, 0, "user", "q", 1),
    ]
    segments = chat.format_conversations(spark.createDataFrame(rows, kind))
    got = {r["conv_id"]: r for r in chat.read_back(segments).collect()}

    def digest(conv):
        turns = sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or ""))
        return hashlib.sha256("".join(f"{r[2] or ''}\n{r[3] or ''}\n" for r in turns).encode()).hexdigest()

    assert {c: r["turns_sha256"] for c, r in got.items()} == {c: digest(c) for c in (1, 2, 3, None)}
    assert (got[1]["state"], got[2]["state"], got[None]["state"]) == ("bad", "bad", "open")
    assert chat.unescape(chat.escape("<|<\\|<\\\\|")) == "<|<\\|<\\\\|"
    assert chat.read_back(chat.format_conversations(spark.createDataFrame([], kind))).count() == 0


@pytest.mark.parametrize("units", [[1], [3, 5, 2], [1, 1, 98], [333, 333, 334], [7, 1, 1, 1]])
def test_period_stays_within_a_block(units):
    order = mixing.period(units)
    q, given = sum(units), [0] * len(units)
    for t, i in enumerate(order, 1):
        given[i] += 1
        assert all(abs(g * q - u * t) < q for g, u in zip(given, units, strict=True))
    assert given == units


def test_mix_keeps_every_row(docs, no_docs, texts):
    out = mixing.mix_sources(docs, {"src0": 0.5, "src1": 0.2, mixing.REST: 0.3}, block_size=200).collect()
    assert sorted((str(r["doc_id"]), r["text"] or "") for r in out) == sorted((str(i), t or "") for i, t, _ in texts)
    starts = {}
    for r in out:
        assert starts.setdefault(r["slot"], (r["mix_group"], r["block"])) == (r["mix_group"], r["block"])
    assert mixing.mix_sources(no_docs, {"src0": 1.0}).count() == 0


@pytest.mark.parametrize("times", [1, 30])
@pytest.mark.parametrize("resolution", [20, 1000])
def test_mix_keeps_targets_up_to_the_first_exhaustion(spark, times, resolution):
    """With fewer blocks than units and with many periods."""
    sizes = {"src0": 12 * times, "src1": 13 * times, "src2": 12 * times, "src3": times, "zzz": 200 * times}
    names = [s for s, n in sizes.items() for _ in range(n)]
    docs = make_docs(spark, [(i, "x" * 10, s) for i, s in enumerate(names)])
    out = mixing.mix_sources(docs, queries.TARGETS, block_size=10, resolution=resolution).select("slot", "mix_group").collect()
    order = [g for _, g in sorted((r["slot"], r["mix_group"]) for r in out)]
    assert sorted(r["slot"] for r in out) == list(range(len(names)))
    total, given = sum(queries.TARGETS.values()), dict.fromkeys(queries.TARGETS, 0)
    have = {g: sizes.get(g, sizes["zzz"]) for g in given}
    for t, g in enumerate(order, 1):
        given[g] += 1
        assert all(abs(given[k] - t * w / total) < 1 for k, w in queries.TARGETS.items())
        if given[g] == have[g]:
            break
    assert t >= 18 * times


def test_repeats_against_brute_force(docs, no_docs, texts):
    got = {(r[0], r[1]): tuple(r)[2:] for r in repeats.remove_repeats(docs).collect()}
    assert repeats.remove_repeats(docs).count() == len(texts)
    rows = sorted({(i, (t or "").encode()) for i, t, _ in texts if i is not None})
    first: dict[bytes, int] = {}
    for i, b in rows:
        gone = bytearray(len(b))
        for p in range(len(b) - 49):
            if first.setdefault(b[p : p + 50], i) < i:
                gone[p : p + 50] = b"\1" * 50
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        spans = sum(1 for p in range(len(b)) if gone[p] and not (p and gone[p - 1]))
        assert got[(i, len(b))] == (sum(gone), spans, hashlib.sha256(kept).hexdigest())
    assert repeats.remove_repeats(no_docs).count() == 0


def test_lines_edges(docs, no_docs, texts):
    out = lines.dedup_lines(docs)
    assert out.columns == [c for c in docs.columns if c != "n_lines"] + ["n_lines", "n_removed"]
    rows = out.collect()
    assert len(rows) == len(texts)
    assert all((r["text"] is None) == (r["n_lines"] == 0) for r in rows)
    kept = [x for r in {(r["doc_id"], r["text"]) for r in rows if r["text"]} for x in r[1].split("\n") if len(x) >= 20]
    assert len(kept) == len(set(kept)), "a long line stays once"
    assert {x for _, t, _ in texts for x in (t or "").split("\n") if len(x) >= 20} == set(kept)
    assert lines.dedup_lines(no_docs).count() == 0


def test_contamination(spark, sf_dir, docs, no_docs):
    want = duck(sf_dir).execute("SELECT doc_id, item_id FROM documents d, benchmark b WHERE contains(d.text, b.text)").fetchall()
    found = queries.QUERIES["op8_benchmark_decontamination"](spark, sf_dir)
    assert {(r["doc_id"], r["item_id"]) for r in found.collect()} >= set(want)
    bench = spark.createDataFrame([(1, None), (2, ""), (3, "short item here today. yes it is"), (3, "short item here today. yes it is")], "item_id bigint, text string")
    hidden = make_docs(spark, [(1, "aa bb " * 300 + "SHORT item here today. yes it is cc " + "dd ee " * 300, "s"), (2, "short item", "s")])
    for shard in (1, 20_000):
        assert {r["doc_id"] for r in contamination.contaminated(hidden, bench, shard_items=shard).collect()} == {1}
    assert contamination.contaminated(no_docs, bench).count() == 0
    assert contamination.decontaminated(docs, bench.limit(0)).count() == docs.count()


def test_contamination_finds_every_whole_item(spark):
    """Items that stand word for word in a text, whatever is glued to them, and in upper case."""
    big = "/root/testdata/sf0.1"
    want = set(duck(big).execute("SELECT doc_id, item_id FROM documents d, benchmark b WHERE contains(d.text, b.text)").fetchall())
    bench = spark.read.parquet(f"{big}/benchmark.parquet")
    found = contamination.contaminated(spark.read.parquet(f"{big}/documents.parquet"), bench).select("doc_id", "item_id")
    assert {tuple(r) for r in found.collect()} >= want
    upper = bench.select(F.col("item_id").alias("doc_id"), F.concat(F.lit("$$$("), F.upper("text"), F.lit(")...&&&")).alias("text"))
    assert contamination.contaminated(upper, bench).where("doc_id = item_id").count() == bench.count()


def test_contamination_edges(spark):
    words = "alpha beta gamma delta epsilon zeta eta theta iota kappa."
    items = [(1, words + " one two three four five"), (2, words + " yes"), (3, "?! :: -> ++"), (4, "\u03bf\u03b4\u03bf\u03c2 stra\u00dfe na\u00efve caf\u00e9")]
    rows = [
        (1, words + " one two other four five", "s"), (2, words + " perhaps", "s"), (3, "x ?! :: -> ++ y", "s"),
        (4, "\u039f\u0394\u039f\u03a3, STRASSE-NA\u00cfVE\u2026CAF\u00c9\u00bb", "s"), (5, None, "s"), (6, "... !!!", "s"),
    ]
    found = contamination.contaminated(make_docs(spark, rows), spark.createDataFrame(items, "item_id bigint, text string"))
    assert {(r["doc_id"], r["item_id"]) for r in found.collect()} == {(1, 1), (3, 3), (4, 4)}
    broken = spark.sql("SELECT 1L AS doc_id, cast(concat(unhex('ff20'), cast(upper('%s yes') AS binary), unhex('ff')) AS string) AS text" % words)
    found = contamination.contaminated(broken, spark.createDataFrame(items[1:2], "item_id bigint, text string"))
    assert found.count() == 1


@pytest.mark.parametrize(("name", "column"), [("op6_quality_classifier", "quality"), ("op9_toxicity", "toxic")])
def test_held_out_accuracy(spark, name, column):
    big = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{big}/labels.parquet")
    out = queries.QUERIES[name](spark, big).where("held_out").join(labels, "doc_id")
    right, n = out.agg(F.sum((F.col("predicted") == F.col(column)).cast("int")), F.count("*")).first()
    # only 305 toxic texts to learn from at this size, some with words seen nowhere else
    assert right / n > (0.96 if column == "quality" else 0.92)


@pytest.mark.parametrize("module", [quality, toxicity])
def test_classifier_edges(spark, docs, no_docs, module):
    column = "quality" if module is quality else "toxic"
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)] + [(61, None), (None, 1)], f"doc_id bigint, {column} int")
    for some in (labels, labels.where(f"{column} = 1"), labels.limit(0)):
        out = module.score(docs, module.train(docs, some))
        assert out.columns == [c for c in docs.columns if c != "score"] + ["score"]
        assert all(0 <= r[0] <= 1 for r in out.select("score").collect())
        assert out.select("text", "score").where("text = 'one'").distinct().count() == 1
    assert module.score(no_docs, module.train(no_docs, labels)).count() == 0


def test_toxic_words_with_inserted_characters():
    rng = random.Random(4)
    words = ["".join(rng.choice("aeiounrst") for _ in range(rng.randint(2, 7))) for _ in range(400)]
    clean = [" ".join(rng.choice(words) for _ in range(40)).encode() for _ in range(300)]
    toxic = [c + b" " + rng.choice((b'blockhead', b'wretchling')) + b'.' for c in clean[:200]]
    model = toxicity.fit(toxic, clean[100:])
    asks = [b"oh bl-ockhead go", b"a w r e t c h l i n g he is", b"wretch.ling", clean[5]]
    p = [v for piece in toxicity._as_pieces(asks) for v in model.probability(model.decisions(piece))]
    assert min(p[:3]) > 0.5 > p[3]


def test_licences(spark, sf_dir, docs, no_docs):
    con = duck(sf_dir)
    want = set()
    for family, part in (("Apache-2.0", "Apache License"), ("MIT", "MIT License"), ("GPL-3.0", "GNU General Public License, version 3"), ("CC-BY-NC", "CC BY-NC 4.0")):
        want |= {(r[0], family) for r in con.execute(f"SELECT doc_id FROM documents WHERE contains(text, '{part}')").fetchall()}
    found = queries.QUERIES["op10_licence_scan"](spark, sf_dir).where("confirmed").collect()
    assert {(r["doc_id"], r["family"]) for r in found} == want
    model = licences.train(docs)
    assert licences.scan(docs, model).where("confirmed").count() == 0
    assert licences.scan(no_docs, model).count() == 0


def test_licences_beyond_the_templates(spark, sf_dir):
    model = licences.train(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    mit = licences.NOTICES["MIT"][2].split()
    wrapped = "\n".join(" ".join(mit[i : i + 5]) for i in range(0, len(mit), 5))
    texts = [
        "SPDX-License-Identifier: Apache-2.0", "GPLv3+", "one two\n \n\n" + wrapped + "\n\nthree", "All rights reserved.",
        "Use follows the Zorblax house licence of the vendor.", "no such words here", None, "", "...",
    ]
    got = {}
    for r in licences.scan(make_docs(spark, [(i, t, "s") for i, t in enumerate(texts)]), model).collect():
        assert got.setdefault(r["doc_id"], r) is r
    assert {i: (r["paragraph"], r["family"], r["confirmed"]) for i, r in got.items()} == {
        0: (0, "Apache-2.0", True), 1: (0, "GPL-3.0", True), 2: (1, "MIT", True), 3: (0, "All-rights-reserved", False), 4: (0, "unknown", False),
    }
    big = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").where("contains(text, 'All rights reserved.')")
    found = licences.scan(big, model).where("family = 'All-rights-reserved'")
    assert found.select("doc_id").distinct().count() == big.select("doc_id").distinct().count() > 0


def test_pipeline_on_edges(spark, docs, tmp_path):
    import corpus_pipeline as cp

    labels = spark.createDataFrame([(i, 1, 0) for i in range(76)], "doc_id bigint, quality int, toxic int")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, "no such item anywhere at all. none")], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for name, rows in (("some", docs), ("none", docs.limit(0))):
        step = rows.select(*cp.COLUMNS)
        for k, (_, stage) in enumerate(cp.STAGES):
            out = stage(spark, step, str(tmp_path))
            if k + 1 < len(cp.STAGES):
                assert out.columns == cp.COLUMNS
            out.write.parquet(f"{tmp_path}/{name}{k}")
            step = spark.read.parquet(f"{tmp_path}/{name}{k}")
        assert (step.count() > 0) == (name == "some")
