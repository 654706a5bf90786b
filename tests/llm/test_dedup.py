"""Exact, near and substring duplicates against brute force."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from sales_engine.llm import exact
from sales_engine.llm.components import smallest_members
from sales_engine.llm.exact import with_copies
from sales_engine.llm.repeats import remove_repeats
from sales_engine.llm.simhash import near_components, near_links

EDGES = [(None, "no key"), (7, None), (8, ""), (9, " \n"), (10, "Ab c"), (11, "aB C"), (11, "aB C"), (None, None)]


def frame(spark, rows, key="doc_id"):
    return spark.createDataFrame(rows, f"{key} long, text string").repartition(3)


# -- strings ----------------------------------------------------------------------------------------------------


def cut(texts, length):
    where = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        mark = np.zeros(len(t) + 2, int)
        for i in range(len(t) - length + 1):
            if where[t[i : i + length]] > 1:
                mark[i + 1 : i + length + 1] = 1
        kept = bytes(b for b, m in zip(t, mark[1:-1], strict=True) if not m)
        out.append((len(t), int(mark.sum()), int((np.diff(mark) == 1).sum()), hashlib.sha256(kept).hexdigest()))
    return out


def repetitive(seed):
    draw = random.Random(seed)
    pool = [bytes(draw.choice(b"abcdefgh ") for _ in range(draw.randint(250, 700))) for _ in range(6)]
    texts = [b"a" * 1500, b"ab" * 400, b""]
    for _ in range(60):
        parts = []
        for _ in range(draw.randint(0, 4)):
            own = draw.choice(pool)
            parts.append(own[draw.randint(0, 90) : len(own) - draw.randint(0, 90)])
            parts.append(bytes(draw.choice(draw.choice([b"abc ", b"a"])) for _ in range(draw.randint(0, 300))))
        texts.append(b"".join(parts))
    return [*texts, *texts[:2]]


@pytest.mark.parametrize("length", [200, 400])
def test_repeats_are_removed_everywhere(spark, length):
    texts = repetitive(length)
    got = remove_repeats(frame(spark, [(i, t.decode()) for i, t in enumerate(texts)]), length=length).orderBy("doc_id").collect()
    assert [(r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got] == cut(texts, length)
    assert all(hashlib.sha256(r.text.encode()).hexdigest() == r.kept_sha256 for r in got)


def test_a_text_longer_than_a_block(spark):
    draw = random.Random(1)
    shared = "".join(draw.choice("abcdefghij ") for _ in range(900))
    long = "".join(draw.choice("abcdefghij ") for _ in range(450_000))
    got = remove_repeats(frame(spark, [(1, long[:200_000] + shared + long[200_000:]), (2, "x" + shared + "y")])).orderBy("doc_id").collect()
    assert [(r.n_removed, r.n_spans) for r in got] == [(900, 1), (900, 1)]
    assert got[0].text == long and got[1].text == "xy"


def test_characters_that_are_cut_apart_leave_the_text(spark):
    rows = [(1, "é" * 300 + "x"), (2, "ab" + "é" * 300)]
    got = remove_repeats(frame(spark, rows)).orderBy("doc_id").collect()
    assert [r.text for r in got] == ["x", "ab"]


def test_shorter_passages_leave_anchors(spark):
    """Strings of 273 bytes after a trigger are compared: of passages of 390 bytes nearly all are seen, and none goes."""
    draw = random.Random(14)
    letters = lambda n: "".join(draw.choice("abcdefghij ") for _ in range(n))
    passages = [letters(390) for _ in range(40)]
    rows = [(2 * i + j, f"{letters(300)}#{j}{p}{j}#{letters(300)}") for i, p in enumerate(passages) for j in (0, 1)]
    got = remove_repeats(frame(spark, [*rows, *[(1000 + i, letters(900)) for i in range(40)]]), keep_text=False).collect()
    assert sum(r.n_removed for r in got) == 0 and not any(r.n_anchors for r in got if r.doc_id >= 1000)
    assert sum(r.n_anchors > 0 for r in got) >= 64


def test_least_words(spark):
    draw = random.Random(15)
    words = lambda n: " ".join("".join(draw.choice("abcdefghij") for _ in range(6)) for _ in range(n))
    long, short = words(60), words(45)
    rows = [(i, f"{i}# {words(20)} # {p} # {words(20)} #{i}") for i, p in enumerate([long, long, short, short])]
    got = {r.doc_id: r for r in remove_repeats(frame(spark, rows), length=200, least_words=51).collect()}
    assert all(long not in got[i].text and got[i].n_spans == 1 for i in (0, 1))
    assert all(got[i].text == rows[i][1] and got[i].n_removed == 0 for i in (2, 3))


def test_shared_runs_of_words(spark):
    """Every run of 51 words that another row has, at any place and of any length in bytes; a text's own repeats don't count."""
    draw = random.Random(16)
    words = lambda n, size=4: ["".join(draw.choice("abcdefghij") for _ in range(size)) for _ in range(n)]
    texts = [words(120) for _ in range(30)]
    for i, n in enumerate([50, 51, 52, 60, 80, 51, 130]):
        passage = words(n, draw.choice([2, 4, 9]))
        for at, text in ((0, texts[3 * i]), (120, texts[3 * i + 1]), (60, texts[3 * i + 2])):
            text[at:at] = passage
    texts += [p + p for p in [words(70)]] + [words(51), [], words(50), ["a"] * 200, ["a"] * 60]
    texts += [texts[5], texts[5], words(70_000)]
    texts[-1][69_000:69_000] = texts[9][:60]
    blanks = ["\n", "  ", " \t"]
    rows = [(i % 30, draw.choice(blanks).join(t)) for i, t in enumerate(texts)]
    held = [{tuple(t[i : i + 51]) for i in range(len(t) - 50)} for t in texts]
    times = Counter(run for runs in held for run in runs)
    got = remove_repeats(frame(spark, rows), keep_text=False, run_words=51).drop("text")
    assert got.columns[-2:] == ["n_anchors", "n_shared_runs"]
    wanted = Counter((i % 30, len("".join(rows[i][1]).encode()), sum(times[r] > 1 for r in held[i])) for i in range(len(texts)))
    assert Counter((r.doc_id, r.n_bytes, r.n_shared_runs) for r in got.collect()) == wanted
    plain = remove_repeats(frame(spark, rows), keep_text=False).drop("text")
    assert got.drop("n_shared_runs").exceptAll(plain).isEmpty() and plain.exceptAll(got.drop("n_shared_runs")).isEmpty()


def test_repeats_edge_cases(spark):
    rows = frame(spark, EDGES).withColumn("N_Bytes", F.lit(5)).withColumn("k1", F.lit("k")).withColumn("row", F.lit(None).cast("int"))
    got = remove_repeats(rows)
    assert got.columns == ["doc_id", "text", "k1", "row", "n_bytes", "n_removed", "n_spans", "kept_sha256", "n_anchors"]
    assert got.count() == len(EDGES) and got.agg(F.sum("n_removed")).first()[0] == 0
    assert remove_repeats(rows.limit(0)).count() == 0
    twice = remove_repeats(frame(spark, [(1, "ab" * 300), (1, "ab" * 300), (None, "z" * 399)])).collect()
    assert sorted(r.n_removed for r in twice) == [0, 600, 600]


# -- equal texts ------------------------------------------------------------------------------------------------


@pytest.mark.parametrize("most_bits", [1024, 2**20])
def test_equal_texts(spark, monkeypatch, most_bits):
    """Even a filter that is far too small changes no result."""
    monkeypatch.setattr(exact, "MOST_BITS", most_bits)
    draw = random.Random(2)
    rows = [(i, draw.choice(["É", "é", "Abc", "aBC", f"own {i}", ""])) for i in range(2000)]
    lower = {i: "".join(c.lower() if c.isascii() else c for c in t) for i, t in rows}
    best, many = {}, Counter(lower.values())
    for i, t in lower.items():
        best[t] = max(i, best.get(t, 0))
    got = with_copies(frame(spark, rows), carry_text=False).collect()
    assert len(got) == len(rows)
    for r in got:
        t = lower[r.doc_id]
        assert (r.keep_id, r.group_size, r.kept) == (best[t], many[t], r.doc_id == best[t])
        assert r.text_sha256 == hashlib.sha256(t.encode()).hexdigest()


def test_equal_texts_edge_cases(spark):
    rows = frame(spark, EDGES).withColumn("maybe", F.lit(1)).withColumn("Keep_ID", F.lit(1))
    got = with_copies(rows)
    assert got.columns == ["doc_id", "text", "maybe", "keep_id", "group_size", "kept", "text_sha256"]
    kept = [(r.doc_id, r.text) for r in got.collect() if r.kept]
    assert sorted(map(str, kept)) == sorted(map(str, [(None, "no key"), (8, ""), (9, " \n"), (11, "aB C")]))
    assert with_copies(rows.limit(0)).count() == 0


# -- near copies ------------------------------------------------------------------------------------------------


def fingerprint(text):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(words):
    words = np.array(words, np.uint64)
    labels = np.arange(len(words))
    near = [np.flatnonzero(np.bitwise_count(words ^ w) <= 2) for w in words]
    while True:
        new = np.array([labels[n].min() for n in near])
        if (new == labels).all():
            return labels
        labels = new


def test_near_copies(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    rows = sorted(map(tuple, docs.collect())) + [(10**9, None), (10**9 + 1, ""), (10**9 + 2, "One"), (10**9 + 3, "one")]
    prints = [fingerprint(t) for _, t in rows]
    labels = components(prints)
    got = near_components(spark.createDataFrame(rows, "doc_id long, text string"), carry_text=False).orderBy("doc_id").collect()
    assert [r.fingerprint % 2**64 for r in got] == prints
    assert [r.component_id for r in got] == [rows[k][0] for k in labels]
    assert sum(r.component_keeper for r in got) == len(set(labels))


@pytest.mark.parametrize("bucket", [4, 128])
def test_links_of_crowded_buckets(spark, bucket):
    """Thousands of words around few centres; small buckets send most of them by the whole words."""
    draw = random.Random(3)
    centres = [draw.getrandbits(64) for _ in range(3)]
    words = set(centres)
    while len(words) < 1500:
        word = draw.choice(centres)
        for _ in range(draw.randint(1, 4)):
            word ^= 1 << draw.randrange(64)
        words.add(word)
    words = sorted(words)
    labels = components(words)
    signed = [w - 2**64 if w >= 2**63 else w for w in words]
    links = near_links(spark.createDataFrame([(w,) for w in signed], "word long"), bucket=bucket)
    assert all((r.a ^ r.b) % 2**64 != 0 and ((r.a ^ r.b) % 2**64).bit_count() <= 2 for r in links.collect())
    root = {r.node: r.root for r in smallest_members(links).collect()}
    least = {}
    for w, label in zip(signed, labels, strict=True):
        least[label] = min(w, least.get(label, w))
    assert [root.get(w, w) for w in signed] == [least[label] for label in labels]


def test_near_copies_edge_cases(spark):
    rows = frame(spark, EDGES).withColumn("word", F.lit(1)).withColumn("row_number_", F.lit(1)).withColumn("Component_ID", F.lit(1))
    got = near_components(rows)
    assert got.columns == ["doc_id", "text", "word", "row_number_", "fingerprint", "component_id", "component_keeper"]
    rows_by = got.groupBy("fingerprint").agg(F.sum(F.col("component_keeper").cast("int")).alias("kept")).collect()
    assert all(r.kept == 1 for r in rows_by) and got.count() == len(EDGES)
    assert near_components(rows.limit(0)).count() == 0
