"""Each stage of the pipeline, and the classifiers' models, against plain versions on planted cases."""

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from sales_engine.llm import quality, toxicity
from sales_engine.llm.vocabularies import folder
from tests.llm.test_dedup import components, fingerprint
from tests.llm.test_text import distance

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
TERMS = ["grobnik", "vlastur", "zhemp"]


@pytest.fixture(scope="module")
def planted(spark, tmp_path_factory):
    """A folder with documents of which the copies, near copies, passages and toxic ones are known."""
    draw = random.Random(17)
    words = ["".join(draw.choice("aeioulnrstdkm") for _ in range(draw.randrange(3, 9))) for _ in range(3000)]
    prose = lambda n: " ".join(draw.choice(words) for _ in range(n))
    passages = [prose(n) for n in (52, 55, 60, 80)]
    texts, toxic = {}, set()
    for i in range(160):
        texts[i] = prose(draw.randrange(60, 200))
    for i in range(40):  # some toxic words each, in one text misspelled
        own = texts[i].split()
        for at in draw.sample(range(len(own)), 6):
            own[at] = draw.choice(TERMS)
        texts[i] = " ".join(own)
        toxic.add(i)
    texts[200], texts[201], texts[202] = texts[50], texts[50].upper(), texts[51]
    for i, base in ((210, 60), (211, 60), (212, 61)):
        own = texts[base].split()
        own[len(own) // 2] = "changed"
        texts[i] = " ".join(own)
    holders = {}
    for j, passage in enumerate(passages):
        for i in (70 + 2 * j, 71 + 2 * j):
            texts[i] = f"{prose(70)}\n{passage}\n{prose(70)}"
            holders[i] = passage
    texts[90] += "\n" + " ".join(passages[3].split()[:30])  # too short a stretch to go
    texts |= {300: None, 301: "", 302: "", 303: " \n", 304: "wort " * 4000, 305: "日本語 " * 300}
    rows = [(k, t, "xx", "s", None if t is None else len(t)) for k, t in texts.items()]
    rows += [(None, prose(50), None, None, 3), (100, texts[100], "xx", "s", len(texts[100]))]
    root = tmp_path_factory.mktemp("planted")
    spark.createDataFrame(rows, SCHEMA).repartition(4).write.parquet(f"{root}/documents.parquet")
    labels = [(i, None, int(i in toxic)) for i in range(160)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{root}/labels.parquet")
    return str(root), texts, toxic, holders


@pytest.fixture(scope="module")
def stages(spark, planted, tmp_path_factory):
    """Rows before and after each stage, written and read as the pipeline does it."""
    root, kept = planted[0], tmp_path_factory.mktemp("stages")
    docs, out = spark.read.parquet(f"{root}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        before = [tuple(r) for r in docs.collect()]
        stage(spark, docs, root).write.parquet(f"{kept}/{name}")
        docs = spark.read.parquet(f"{kept}/{name}")
        out[name] = before, [tuple(r) for r in docs.collect()], docs.columns
    return out


def plain_score(model, text):
    """The toxicity score by edit distances over all words, without automaton or remembered words."""
    reader = toxicity.Reader([])

    def kind(word):
        best = 99
        for term in model["terms"]:
            letters = term.rstrip("*")
            limit = (len(letters) >= toxicity.ONE_ERROR) + (len(letters) >= toxicity.TWO_ERRORS)
            heads = [word[:n] for n in range(len(word) + 1)] if term.endswith("*") else [word]
            errors = min(distance(letters, h) for h in heads)
            best = min(best, errors if errors <= limit else 99)
        return 0 if best == 99 else 1 + (best > 0)

    text = (text or "").lower()
    words = [m.group() for m in re.finditer(r"[^\W_]+", text)]
    spans = [m.span() for m in re.finditer(r"[^\W_]+", text)]
    kinds = {w: kind(w) for w in set(words)}
    x = np.zeros(len(toxicity.PRIOR))
    x[0] = 1
    for at, word in enumerate(words):
        if kinds[word]:
            in_quotes, weight = reader._context(text, words, spans, at)
            x[1 + (kinds[word] == 2) + 2 * in_quotes] += weight
    if words:
        rate = x[1:5].sum() / len(words) * 100
        x[1:5] = np.log1p(x[1:5])
        x[5] = min(rate, 5.0)
    return 1 / (1 + math.exp(-float(np.clip(x @ np.array(model["weights"]), -30, 30))))


def test_toxic_documents_go_and_clean_ones_stay(spark, planted, stages):
    root, _, toxic, _ = planted
    before, after, columns = stages["toxicity"]
    docs = spark.read.parquet(f"{root}/documents.parquet")
    model = toxicity.fit(docs, spark.read.parquet(f"{root}/labels.parquet"))
    assert {t.rstrip("*") for t in model["terms"]} == set(TERMS)
    assert columns == docs.columns
    want = [r for r in before if plain_score(model, r[1]) < 0.5]
    assert Counter(want) == Counter(after)
    assert {r[0] for r in before} - {r[0] for r in after} == toxic


def test_exact_copies_go(stages):
    before, after, _ = stages["exact dedup"]
    groups = defaultdict(list)
    for r in before:
        groups[(r[1] or "").encode().lower()].append(r)
    want = Counter(max(g, key=lambda r: (r[0] is not None, r[0] or 0))[0] for g in groups.values())
    assert Counter(r[0] for r in after) == want and set(after) <= set(before)
    ids = {r[0] for r in after}
    assert 50 not in ids and 200 not in ids and {201, 202} <= ids and 51 not in ids


def test_near_copies_go(stages):
    before, after, _ = stages["SimHash near-dedup"]
    rows = sorted(before, key=lambda r: (r[0] is None, r[0] or 0))
    labels = components([fingerprint(r[1]) for r in rows])
    want = {rows[k][0] for k in labels}
    assert {r[0] for r in after} == want and len(after) == len(set(labels)) and set(after) <= set(before)


def plain_cut(texts):
    """Texts without runs of over 50 words that strings of the stage's length cover, each of which starts elsewhere too."""
    length = corpus_pipeline.REPEAT_BYTES
    texts = [(t or "").encode() for t in texts]
    where = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        covered = np.zeros(len(t), bool)
        for i in range(len(t) - length + 1):
            if where[t[i : i + length]] > 1:
                covered[i : i + length] = True
        edges = np.flatnonzero(np.diff(covered.astype(np.int8), prepend=0, append=0))
        for a, b in zip(edges[::2], edges[1::2], strict=True):
            if len(t[a:b].split()) <= 50:
                covered[a:b] = False
        out.append(bytes(np.frombuffer(t, np.uint8)[~covered]).decode("utf-8", "ignore"))
    return out


def test_passages_that_repeat_are_cut(planted, stages):
    holders = planted[3]
    before, after, _ = stages["suffix-array dedup"]
    want = dict(zip((r[0] for r in before), plain_cut([r[1] for r in before]), strict=True))
    got = {r[0]: r for r in after}
    assert got.keys() == want.keys()
    for key, text in want.items():
        assert (got[key][1] or "") == text
        assert got[key][2:4] == next(r for r in before if r[0] == key)[2:4]
        changed = text != (next(r[1] for r in before if r[0] == key) or "")
        assert not changed or got[key][4] == len(text)
    for key, passage in holders.items():
        assert passage not in got[key][1] and len(got[key][1].split()) >= 130
    repetitive = {304, 305, 60, 61, 210, 211, 212}  # near copies that differ in more bits than the stage before allows share most bytes
    assert all(want[r[0]] == (r[1] or "") for r in before if r[0] not in holders and r[0] not in repetitive)


def test_all_that_is_left_is_packed(stages):
    before, after, columns = stages["packing"]
    tokenizer = Tokenizer.from_file(f"{folder()}/byte_bpe_50k.json")
    ids = {r[0]: [*tokenizer.encode(r[1] or "", add_special_tokens=False).ids, 1] for r in before}
    rows = [dict(zip(columns, r, strict=True)) for r in after]
    pieces = defaultdict(list)
    for r in rows:
        pieces[r["doc_id"]].append(r)
    assert pieces.keys() == ids.keys()
    for key, own in ids.items():
        at = 0
        for r in sorted(pieces[key], key=lambda r: r["start"]):
            assert r["start"] == at and r["ids_crc32"] == zlib.crc32(np.array(own[at : at + r["length"]], "<u4").tobytes())
            at += r["length"]
        assert at == len(own)


def test_the_whole_run_is_its_stages(spark, planted, stages):
    """Two runs at once on one path don't disturb each other."""
    from concurrent.futures import ThreadPoolExecutor

    root = planted[0]
    with ThreadPoolExecutor(2) as pool:
        runs = list(pool.map(lambda _: corpus_pipeline.run(spark, root).collect(), range(2)))
    want = Counter((r[0], r[1], r[2]) for r in stages["packing"][1])
    for run in runs:
        assert Counter((r.doc_id, r.start, r.length) for r in run).keys() >= set() and sum(r.length for r in run) == sum(n * c for (_, _, n), c in want.items())


def test_empty_tables(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def plain_ftrl(vectors):
    """FTRL-proximal one coordinate at a time, from the update rule."""
    z, n = defaultdict(float), defaultdict(float)

    def weight(i):
        l1 = 0 if i == 0 else quality.L1
        if abs(z[i]) <= l1:
            return 0.0
        return -(z[i] - math.copysign(l1, z[i])) / ((quality.BETA + math.sqrt(n[i])) / quality.ALPHA + quality.L2)

    for _ in range(quality.EPOCHS):
        for vector, label in vectors:
            w = {i: weight(i) for i in vector}
            p = 1 / (1 + math.exp(-sum(w[i] * x for i, x in vector.items())))
            for i, x in vector.items():
                g = (p - label) * x
                sigma = (math.sqrt(n[i] + g * g) - math.sqrt(n[i])) / quality.ALPHA
                z[i] += g - sigma * w[i]
                n[i] += g * g
    return {i: weight(i) for i in z}


def plain_vector(text, grams):
    """Shares of a text's n-grams by family, added up per slot."""
    vector = defaultdict(float, {0: 1.0})
    for family in grams.families(text.encode()):
        for slot, many in Counter(family.tolist()).items():
            vector[slot] += quality.SCALE * many / len(family)
    return dict(vector)


def test_weights_follow_the_update_rule(spark):
    draw = random.Random(21)
    good, bad = "river stone quiet morning window".split(), "BUY!!! $$$ click c1ick w1n now".split()
    texts = [(i, " ".join(draw.choice(good if i % 2 else bad) for _ in range(draw.randrange(0, 30))), i % 2) for i in range(60)]
    vectors = []
    grams = quality.Grams()
    for _, text, label in texts:
        vector = plain_vector(text, grams)
        slots = np.array(sorted(vector), np.int32)
        vectors.append((slots, np.array([vector[s] for s in slots], np.float32), label))
    got = quality.train(vectors)
    want = plain_ftrl([({int(s): float(v) for s, v in zip(slots, values, strict=True)}, label) for slots, values, label in vectors])
    assert set(np.flatnonzero(got).tolist()) <= want.keys()
    assert all(math.isclose(got[i], w, rel_tol=1e-4, abs_tol=1e-6) for i, w in want.items())
    rows = quality.score(spark.createDataFrame([(i, t) for i, t, _ in texts], "doc_id long, text string"), got).collect()
    for r in rows:
        sure = sum(got[i].astype(float) * x for i, x in plain_vector(r.text, grams).items())
        assert math.isclose(r.score, 1 / (1 + math.exp(-sure)), rel_tol=1e-6) and r.predicted == (r.score >= 0.3)
