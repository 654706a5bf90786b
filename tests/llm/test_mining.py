"""Decontamination, collocations and resampling against plain Python."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from sales_engine.llm import collocations as mining
from sales_engine.llm.automata import CountAutomaton, Grams
from sales_engine.llm.contamination import decontaminate, mark_contaminated
from sales_engine.llm.importance import FeatureHash, cutoff, resample
from sales_engine.llm.words import ALPHANUMERIC, blocks

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words_of(text):
    return re.findall(r"[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", (text or "").translate(LOWER))


def sentence(rng, n, vocabulary=30):
    return " ".join(f"w{rng.randrange(vocabulary)}é" if rng.random() < 0.2 else f"W{rng.randrange(vocabulary)}" for _ in range(n))


# -- decontamination -------------------------------------------------------


def judged(text, items):
    words, hit, found = words_of(text), set(), set()
    for key, item in items:
        w = words_of(item)
        n = min(10, len(w))
        windows = {tuple(w[i : i + n]) for i in range(max(1, len(w) - 9))} if w else set()
        for p in range(len(words) - n + 1):
            if n and tuple(words[p : p + n]) in windows:
                hit.update(range(p, p + n))
                if key is not None:
                    found.add(str(key))
    return len(words), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)


@pytest.fixture(scope="module")
def contaminated(spark):
    rng = random.Random(5)
    items = [(i, sentence(rng, rng.choice([10, 11, 14, 25]))) for i in range(8)]
    items += [(20, items[0][1].upper()), (None, sentence(rng, 12)), (30, None), (31, " ?! "), (100, items[3][1] + " tail")]
    docs = [(i, sentence(rng, rng.randrange(0, 60))) for i in range(40)]
    for i, (_, item) in enumerate(items):
        if item:
            docs.append((100 + i, f"{sentence(rng, i)} -- {item.replace(' ', ', ')}! {sentence(rng, 7)}"))
            docs.append((200 + i, " ".join(words_of(item)[: 9 + i % 2])))  # nine words of ten don't count
    docs += [(300, None), (301, ""), (302, "... "), (None, items[1][1]), (100, docs[41][1]), (100, docs[41][1]), (303, "w1 " * 3000 + items[2][1])]
    docs.append((304, f"{items[1][1]} {items[2][1]} x {items[1][1]}"))
    return docs, items


@pytest.mark.parametrize("limit", [64 * 2**20, 0], ids=["broadcast", "shuffled"])
@pytest.mark.parametrize("short", [(), ((40, "w7 W8 zz"), (41, "zz")), ((40, "w1 w2 w3 w4 w5 w6"),)], ids=["long", "tiny", "shorter"])
def test_marks_like_plain_search(spark, contaminated, limit, short):
    docs, items = contaminated
    items = [*items, *short]
    rows = [(k, t, "mine", 7) for k, t in docs] + [(400, "a zz b w7 w8 ZZ", "x", 1)]
    got = mark_contaminated(
        spark.createDataFrame(rows, "doc_id long, text string, N_Hit string, `a.b` int"),
        spark.createDataFrame(items, "item_id long, text string"), broadcast_bytes=limit,
    )
    assert got.columns == ["doc_id", "text", "a.b", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    want = sorted(repr((k, t, n, *judged(t, items))) for k, t, _, n in rows)
    assert sorted(repr(tuple(r)) for r in got.collect()) == want


def test_no_items_and_no_documents(spark, contaminated):
    docs, items = contaminated
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    none = spark.createDataFrame([], "item_id long, text string")
    got = mark_contaminated(frame, none).collect()
    assert len(got) == len(docs) and not any(r.contaminated or r.n_items or r.n_hit for r in got)
    assert sum(r.n_words for r in got) == sum(len(words_of(t)) for _, t in docs)
    assert mark_contaminated(frame.limit(0), spark.createDataFrame(items, "item_id long, text string")).count() == 0


def test_removal_of_spans_and_documents(spark, contaminated):
    docs, items = contaminated
    frame = spark.createDataFrame([(k, t, "s") for k, t in docs], "doc_id long, text string, spans string")
    test = spark.createDataFrame(items, "item_id long, text string")
    cut = decontaminate(frame, test)
    assert cut.columns == frame.columns
    before = Counter(t for _, t in docs if not judged(t, items)[4])
    after = Counter(r.text for r in cut.collect())
    assert len(before - after) == 0 and sum(after.values()) == len(docs)
    lost = sum(judged(t, items)[1] for _, t in docs)
    assert sum(len(words_of(t)) for _, t in docs) - sum(len(words_of(r.text)) for r in cut.collect()) == lost
    one = decontaminate(spark.createDataFrame([(1, f"Start, one. {items[0][1]}; the end!")], "doc_id long, text string"), test).first()
    assert one.text == "Start, one; the end!"
    whole = decontaminate(frame, test, remove="documents")
    assert Counter(r.text for r in whole.collect()) == before
    with pytest.raises(ValueError):
        decontaminate(frame, test, remove="all")


# -- automata and collocations ---------------------------------------------


def held(automaton):
    grams = automaton.grams()
    return {tuple(grams.words[i] for i in row if i >= 0): int(n) for row, n in zip(grams.rows.tolist(), grams.counts, strict=True)}


def automaton_of(counts):
    words = sorted({w for g in counts for w in g})
    rows = np.full((len(counts), 4), -1)
    for i, g in enumerate(counts):
        rows[i, : len(g)] = [words.index(w) for w in g]
    return CountAutomaton.of(Grams(words, rows, np.array(list(counts.values()), np.int64)))


def test_automata_hold_sum_and_compose():
    def made(seed, n):
        draw = random.Random(seed)
        return Counter(tuple(b"%d" % draw.randrange(9) for _ in range(draw.randrange(1, 5))) for _ in range(n))

    for n in (0, 1, 50, 900):
        one, two = made(n, n), made(n + 1, n)
        a, b = automaton_of(one), automaton_of(two)
        assert held(a) == dict(one) and held(CountAutomaton.from_bytes(a.to_bytes())) == dict(one)
        assert held(CountAutomaton.union([a, b])) == dict(one + two)
        found = a.composed(b)
        got = {tuple(found.words[i] for i in row if i >= 0): int(c) for row, c in zip(found.rows.tolist(), found.counts, strict=True)}
        assert got == {g: c for g, c in one.items() if g in two}
    same = automaton_of({(b"%d" % i, b"x", b"y"): 1 for i in range(200)})
    assert len(same.first) - 1 == 4  # the end, after x, after the first word, the root


def plain_collocations(rows, least, most=2000):
    counts, n = defaultdict(Counter), Counter()
    for text, lang in rows:
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n["und" if lang is None else lang] += len(words)
            for size in range(1, 5):
                for i in range(len(words) - size + 1):
                    counts["und" if lang is None else lang][tuple(words[i : i + size])] += 1
    out = []
    for lang, f in counts.items():
        candidates = {g: a for g, a in f.items() if len(g) > 1 and a >= least}
        within = Counter()
        for g, a in candidates.items():
            for size in range(2, len(g)):
                for i in range(len(g) - size + 1):
                    within[g[i : i + size]] = max(within[g[i : i + size]], a)
        scored = []
        for g, a in candidates.items():
            if 100 * within[g] >= 80 * a:
                continue
            score, k = min((2000000 * a // (f[g[:k]] + f[g[k:]]), k) for k in range(1, len(g)))
            scored.append((-score, -a, " ".join(g).encode(), f[g[:k]], f[g[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(scored)[:most], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n[lang], -score))
    return sorted(out)


def corpus():
    rng = random.Random(8)
    rows = []
    for i in range(120):
        lang = rng.choice(["en", "en", "fr", None, ""])
        text = " ".join(rng.choice(["the", "The", "of", "a", f"w{rng.randrange(12)}", "é", "zwölf", "new york city hall"]) + rng.choice(["", "", "", ",", ".", "\t", "\n", "\r"]) for _ in range(rng.randrange(60)))
        rows.append((text, lang))
    return rows + [(None, "en"), ("", None), (" .,; ", "fr"), ("solo", "xx"), ("x y " * 400, "xx"), rows[0], rows[0]]


@pytest.mark.parametrize("range_words", [2_000_000, 25], ids=["whole", "cut"])
def test_collocations_like_plain_counting(spark, monkeypatch, range_words):
    monkeypatch.setattr(mining, "RANGE_WORDS", range_words)
    rows = corpus()
    docs = spark.createDataFrame([(t, lang, 1, 2) for t, lang in rows], "text string, lang string, rank int, f int").repartition(3)
    for least, most in ((5, 2000), (2, 7), (10**6, 5)):
        got = sorted(tuple(r) for r in mining.collocations(docs, least=least, most=most).collect())
        assert got == plain_collocations(rows, least, most)
    assert mining.collocations(docs.limit(0)).count() == 0


def test_long_texts_count_as_short_ones():
    rng = random.Random(2)
    texts = [(" ".join(f"w{rng.randrange(50)}" for _ in range(n)) + rng.choice(["", " ", ". "])).encode() for n in (0, 1, 700, 3, 2000)]
    texts += [b"x" * 900, b"", b"a " + b"y" * 400 + b" b c d " + b"z" * 300]
    whole = Counter()
    cut = Counter()
    for size, into in ((10**6, whole), (64, cut)):
        for words in blocks(texts, ALPHANUMERIC, 2, size):
            for j in np.flatnonzero(words.fresh):
                for n in (1, 2, 3):
                    if j >= n - 1 and words.piece[j] == words.piece[j - n + 1]:
                        into[int(words.text[j]), tuple(words.words[c] for c in words.codes[j - n + 1 : j + 1])] += 1
    assert whole == cut and sum(whole.values()) > 8000


# -- resampling ------------------------------------------------------------


def test_checksums_of_runs():
    rng = random.Random(4)
    text = " ".join("".join(rng.choice("abé9") for _ in range(rng.choice([1, 3, 9, 254, 255, 256, 700]))) for _ in range(60))
    words = words_of(text)
    want = Counter(zlib.crc32(" ".join(words[i : i + n]).encode()) for n in (1, 2, 3) for i in range(len(words) - n + 1))
    got = Counter()
    for block in blocks([text.encode()], ALPHANUMERIC, 2, 500):
        for _, sums in FeatureHash().runs(block):
            got.update(sums.tolist())
    assert got == want


def features(text, buckets=10_000):
    w = words_of(text)
    return [zlib.crc32(" ".join(w[i : i + n]).encode()) % buckets for n in (1, 2, 3) for i in range(len(w) - n + 1)]


def test_resampling_like_plain_scores(spark):
    rng = random.Random(6)
    target = [sentence(rng, 30, 8) for _ in range(6)] + [None, ""]
    docs = [(i, sentence(rng, rng.randrange(0, 50), rng.choice([8, 40]))) for i in range(300)]
    docs += [(7, docs[7][1])] * 3 + [(None, docs[9][1]), (None, docs[9][1]), (900, None), (901, "")]
    s, t = Counter(), Counter()
    for _, text in docs:
        s.update(features(text))
    for text in target:
        t.update(features(text))
    all_s, all_t = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (all_s + 10000) / ((s[b] + 1) * (all_t + 10000)))) for b in range(10_000)]
    want = []
    for key, text in docs:
        f = features(text)
        h = int(hashlib.sha256(f"42:{'' if key is None else key}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in f)
        want.append((key, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), len(words_of(text)) >= 20))
    order = sorted((-r[3], r[0] is None, r[0] or 0) for r in want if r[4])
    for percent in (5, 50, 100, 0):
        frame = spark.createDataFrame([(k, x, "r") for k, x in docs], "doc_id long, text string, RANK string").repartition(3)
        got = resample(frame, spark.createDataFrame([(x,) for x in target], "text string"), percent=percent, carry_text=percent == 50)
        rows = got.collect()
        assert got.columns == ["doc_id", *(["text"] if percent == 50 else []), "n_features", "weight", "score", "rank"]
        assert Counter((r.doc_id, r.n_features, r.weight, r.score) for r in rows) == Counter(r[:4] for r in want)
        drawn = sorted((r for r in rows if r["rank"] is not None), key=lambda r: r["rank"])
        many = percent * len(order) // 100
        assert [r["rank"] for r in drawn] == list(range(1, many + 1))
        assert [(-r.score, r.doc_id is None, r.doc_id or 0) for r in drawn] == order[:many]
    clash = resample(frame.drop("RANK").withColumnsRenamed({"doc_id": "score", "text": "Weight"}), frame.limit(0), key="score", text="Weight")
    assert clash.columns == ["n_features", "weight", "score", "rank"] and clash.where("rank is not null").count() == 5 * len(order) // 100
    empty = resample(frame.limit(0), frame.limit(0))
    assert empty.count() == 0
    with pytest.raises(TypeError):
        resample(spark.createDataFrame([("a", "b")], "doc_id string, text string"), frame)


def test_cutoffs(spark):
    from pyspark.sql import functions as F

    rng = random.Random(1)
    values = [rng.choice([-5, 0, 3, 10**9, 10**9 + 1, -(2**40), rng.randrange(1000)]) for _ in range(200)]
    frame = spark.createDataFrame([(v,) for v in values], "v long")
    for need in (1, 37, 100, 199, 200):
        at = sorted(values)[need - 1]
        assert cutoff(frame, F.col("v"), need) == (at, sum(v < at for v in values), sum(v <= at for v in values))
