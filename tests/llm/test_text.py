"""Fertility, classifiers, sampled segmentations and packing."""

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from sales_engine.llm import fertility, quality, toxicity
from sales_engine.llm.fertility import judge_fertility, script_of
from sales_engine.llm.packing import pack
from sales_engine.llm.sampling import Lattices, Pieces, _hash, decode, encode, round_trip
from sales_engine.llm.vocabularies import byte_bpe, folder, pieces_model

EDGES = [(None, "no key"), (-7, None), (-8, ""), (-9, " \n"), (-10, "日本語 ▁ \t\r\nx"), (-10, "日本語 ▁ \t\r\nx"), (-11, "a" * 30_000)]


@pytest.fixture(scope="module")
def docs(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    return spark.createDataFrame(rows + EDGES, "doc_id long, text string").repartition(3).cache()


@pytest.fixture(scope="module")
def labels(spark):
    return spark.read.parquet("/root/testdata/sf0.01/labels.parquet")


@pytest.fixture(scope="module")
def labelled(spark):
    return spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")


# -- fertility --------------------------------------------------------------------------------------------------


def counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = Counter(zip(words, words[1:], words[2:], strict=False))
    again = set()
    for i in range(len(words) - 2):
        if windows[tuple(words[i : i + 3])] > 1:
            again |= {i, i + 1, i + 2}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(again)


def test_counts_and_verdicts(docs):
    got = judge_fertility(docs.withColumn("whole", F.col("text")), byte_bpe(), pieces_model()).collect()
    assert len(got) == docs.count()
    for r in got:
        n = counts(r.whole)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == n
        assert r.base_failed == (n[0] < 50 or 2 * n[4] > n[0]) and not (r.base_failed and r.kept)


def test_a_band_rejects_what_is_unlike_its_language(spark):
    draw = random.Random(4)
    rows = [(i, " ".join(draw.choice("the of and to in that with house water people number sound".split()) + str(draw.randrange(9)) for _ in range(200))) for i in range(150)]
    odd = (999, " ".join("".join(draw.choice("qxzjkvw") for _ in range(9)) for _ in range(200)))
    got = {r.doc_id: r for r in judge_fertility(spark.createDataFrame([*rows, odd], "doc_id long, text string"), byte_bpe(), pieces_model()).collect()}
    assert not got[999].kept and not got[999].base_failed
    assert sum(got[i].kept for i, _ in rows) >= 149


def test_groups_of_one_are_judged(spark):
    draw = random.Random(6)
    plain = "the of and to in that with house water people number sound".split()
    prose = lambda: " ".join(draw.choice(plain) + str(draw.randrange(9)) for _ in range(200))
    odd = " ".join("".join(draw.choice("qxzjkvw") for _ in range(9)) for _ in range(200))
    han = " ".join("".join(chr(draw.randrange(0x4E00, 0x9FA0)) for _ in range(4)) for _ in range(200))
    rows = [(i, prose(), "en") for i in range(120)]
    rows += [(900, prose(), "xx"), (901, prose(), None), (902, odd, "yy"), (903, odd, None), (904, han, "en"), (905, han, "zz")]

    def kept(some):
        table = spark.createDataFrame(some, "doc_id long, text string, lang string")
        got = judge_fertility(table, byte_bpe(), pieces_model(), language="lang").collect()
        assert len(got) == len(some) and not any(r.base_failed for r in got)
        return {r.doc_id for r in got if r.kept}

    assert {900, 901} <= kept(rows) and not {902, 903, 904, 905} & kept(rows)
    assert kept(rows[:1]) == {0} and kept(rows[-4:-3]) == set()


def plain_verdicts(rows):
    """The bands and verdicts of rows of (language, script, figures), by sorting."""
    def middle(values):
        return sorted(values)[(len(values) - 1) // 2]

    limits = {}
    for spoken, script in {r[:2] for r in rows}:
        for i, (name, (unit, low, high, least)) in enumerate(fertility.BANDS.items()):
            centre, spread = fertility.PRIOR[name]
            for level in (lambda r: True, lambda r: r[1] == script, lambda r: r[:2] == (spoken, script)):
                steps = [math.floor(r[2 + i] * unit + 0.5) for r in rows if level(r)]
                median = middle(steps)
                n, k = len(steps), fertility.DRAWN_TEXTS
                centre = (n * median / unit + k * centre) / (n + k)
                spread = (n * middle([abs(s - median) for s in steps]) / unit + k * spread) / (n + k)
            width = max(least, spread * fertility.WIDTH)
            limits[spoken, script, name] = (centre - width if low else -math.inf, centre + width if high else math.inf)
    return [all(limits[r[0], r[1], n][0] <= r[2 + i] <= limits[r[0], r[1], n][1] for i, n in enumerate(fertility.BANDS)) for r in rows]


def plain_figures(text):
    """Tokens by the public file itself, pieces by the model itself."""
    import sentencepiece

    whole = Tokenizer.from_file(f"{folder()}/byte_bpe_50k.json")
    encoder = byte_bpe()()
    model = sentencepiece.SentencePieceProcessor(model_file=pieces_model())
    ids = whole.encode(text, add_special_tokens=False).ids
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    pieces = [p for w in words for p in model.encode(w)]

    def broken(i):
        try:
            encoder.fast.decode_single_token_bytes(i).decode()
        except UnicodeDecodeError:
            return True
        return False

    share = [n / len(ids) for n in Counter(ids).values()]
    return (
        len(text) / len(ids), sum(map(len, words)) / len(pieces), sum(map(broken, ids)) / len(ids),
        sum(model.is_byte(p) for p in pieces) / len(pieces), -sum(p * math.log2(p) for p in share),
    )


def test_figures_bands_and_verdicts_like_plain_ones(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").selectExpr("doc_id", "text", "lang AS Script", "text AS whole")
    more = spark.createDataFrame(EDGES, "doc_id long, text string").selectExpr("doc_id", "text", "'xx' AS Script", "text AS whole")
    rows = judge_fertility(docs.unionAll(more), byte_bpe(), pieces_model(), language="Script").collect()
    assert len(rows) == docs.count() + len(EDGES)
    spoken = {r.doc_id: r.Script for r in docs.unionAll(more).collect()}
    judged = [r for r in rows if not r.base_failed]
    for r in judged[::9]:
        assert np.allclose([r[n] for n in fertility.BANDS], plain_figures(r.whole), rtol=1e-9, atol=1e-12)
    figures = [(spoken[r.doc_id], r.script, *[r[n] for n in fertility.BANDS]) for r in judged]
    assert [r.kept for r in judged] == plain_verdicts(figures)
    assert not any(r.kept for r in rows if r.base_failed)


def test_bands_follow_the_spread(spark):
    """Junk that differs by more than the prose of its language spreads is rejected; the prose stays, at any number of texts."""
    draw = random.Random(9)
    letters = {"xx": "etaoinshrdlu", "yy": "aeioumnlrst"}
    lexicon = {k: ["".join(draw.choice(v) for _ in range(draw.randrange(2, 8))) for _ in range(400)] for k, v in letters.items()}
    prose = lambda k: " ".join(draw.choice(lexicon[k]) for _ in range(draw.randrange(80, 300)))
    junk = lambda: " ".join("".join(draw.choice("bcdfgjkqvwxz#%0123456789") for _ in range(draw.randrange(3, 9))) for _ in range(150))
    for many in (5, 60, 101, 400):
        rows = [(i, prose(k), k) for i, k in enumerate(["xx"] * many + ["yy"] * (many // 4))] + [(10_000 + i, junk(), "xx") for i in range(max(1, many // 20))]
        table = spark.createDataFrame(rows, "doc_id long, text string, lang string")
        kept = {r.doc_id: r.kept for r in judge_fertility(table, byte_bpe(), pieces_model(), language="lang").collect()}
        assert np.mean([v for k, v in kept.items() if k < 10_000]) >= 0.97
        if many > 50:
            assert not any(v for k, v in kept.items() if k >= 10_000)


def test_low_quality_is_rejected_more_often_than_good(spark, labels):
    """The labels take no part in the bands; they only tell what the bands catch."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang")
    rows = judge_fertility(docs, byte_bpe(), pieces_model(), language="lang").where("not base_failed").join(labels, "doc_id").collect()
    rejected = {q: np.mean([not r.kept for r in rows if r.quality == q]) for q in (0, 1)}
    assert rejected[0] >= 0.7 and rejected[1] <= 0.03


def test_fertility_edge_cases(docs):
    assert judge_fertility(docs.limit(0), byte_bpe(), pieces_model()).count() == 0
    clash = docs.withColumn("script", F.lit(1)).withColumn("Kept", F.lit(1))
    assert judge_fertility(clash, byte_bpe(), pieces_model()).columns.count("script") == 1
    assert [script_of(t, 0) for t in ("привет мир", "日本語の文", "")] == ["cyrillic", "han", "latin"]


# -- classifiers ------------------------------------------------------------------------------------------------


@pytest.mark.parametrize("module, label, floor", [(quality, "quality", 0.9), (toxicity, "toxic", 0.9)])
def test_held_out_accuracy(labelled, labels, module, label, floor):
    model = module.fit(labelled, labels)
    rows = module.score(labelled, model).join(labels, "doc_id").where("held_out").collect()
    assert all((zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows) and len(rows) > 50
    assert np.mean([r.predicted == r[label] for r in rows]) >= floor


@pytest.mark.parametrize("module, label", [(quality, "quality"), (toxicity, "toxic")])
def test_scores_of_edge_cases(spark, docs, labels, module, label):
    model = module.fit(docs, labels.limit(0))
    rows = module.score(docs.withColumn("score", F.lit("x")).withColumn("PREDICTED", F.lit(1)), model).collect()
    assert len(rows) == docs.count() and all(0 <= r.score <= 1 for r in rows)
    nulls = spark.createDataFrame([(None, 1), (1, None)], f"doc_id long, {label} int")
    assert module.fit(docs, nulls) is not None
    assert module.score(docs.limit(0), model).count() == 0


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(new[-1] + 1, row[j] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def test_automaton_against_edit_distance():
    draw = random.Random(5)
    terms = ["".join(draw.choice("abcd") for _ in range(draw.randint(3, 10))) + draw.choice(["", "*"]) for _ in range(25)]
    automaton = toxicity.Automaton(terms)
    for _ in range(3000):
        word = "".join(draw.choice("abcdz") for _ in range(draw.randint(1, 12)))
        if draw.random() < 0.7:
            own = list(draw.choice(terms).rstrip("*"))
            own[draw.randrange(len(own))] = draw.choice(["", "z", "aa"])
            word = "".join(own)
        best = 99
        for term in terms:
            letters = term.rstrip("*")
            ends = range(len(word) + 1) if term.endswith("*") else [len(word)]
            errors = min(distance(word[:n], letters) for n in ends)
            if errors <= (len(letters) >= 5) + (len(letters) >= 9):
                best = min(best, errors)
        assert automaton.errors(word) == best, word


def test_quotation_weighs_less_than_abuse():
    reader = toxicity.Reader(["moron"])
    score = lambda text: float(reader.features(text) @ toxicity.PRIOR)
    assert score("you are a moron") > score("what a moron here") > score("what a morron here") > score("nothing to see")
    assert score('a letter said "such a moron" in print') < score("a letter is such a moron in print")


# -- sampled pieces ---------------------------------------------------------------------------------------------


def segmentations(pieces, unit):
    out = {}

    def go(at, tokens, weight):
        if at == len(unit):
            out[tuple(tokens)] = math.exp(weight)
            return
        for end in range(at + 1, len(unit) + 1):
            if (token := pieces.ids.get(unit[at:end])) is not None:
                go(end, [*tokens, token], weight + pieces.weights[token])
        if unit[at] not in pieces.ids:
            go(at + 1, [*tokens, pieces.byte_ids[ord(unit[at])]], weight + pieces.fallback)

    go(0, [], 0.0)
    total = sum(out.values())
    return {k: v / total for k, v in out.items()}


@pytest.mark.parametrize("unit", [" the", " ering", "ab\tc", "   x"])
def test_samples_follow_the_lattice(unit):
    lattices, many = Lattices(Pieces(pieces_model(), 1.0)), 40_000
    tokens, taken = lattices.sample([unit] * many, _hash(np.arange(many).astype(np.uint64)))
    ends = np.cumsum(taken)
    seen = Counter(tuple(tokens[e - n : e].tolist()) for e, n in zip(ends, taken, strict=True))
    expected = segmentations(lattices.pieces, unit)
    assert set(seen) <= set(expected)
    for tokens, share in expected.items():
        assert abs(seen[tokens] / many - share) < 5 * math.sqrt(share * (1 - share) / many) + 1e-3


def test_round_trip(docs):
    first = sorted(map(str, round_trip(docs, pieces_model()).collect()))
    assert first == sorted(map(str, round_trip(docs.repartition(7), pieces_model()).collect()))
    assert all("lossless=True" in r for r in first) and len(first) == docs.count()
    other = round_trip(docs, pieces_model(), seed=1)
    assert sorted(map(str, other.collect())) != first and other.where("not lossless").isEmpty()
    both = decode(encode(docs.withColumn("whole", F.coalesce("text", F.lit(""))), pieces_model()), pieces_model())
    assert both.where("decoded <> whole or decoded is null").isEmpty()
    assert round_trip(docs.limit(0), pieces_model()).count() == 0
    clash = round_trip(docs.limit(5).withColumnRenamed("doc_id", "n_tokens"), pieces_model(), key="n_tokens")
    assert clash.columns == ["n_tokens", "n_tokens_", "ids_crc32", "decoded_sha256", "lossless"] and clash.count() == 5


# -- packing ----------------------------------------------------------------------------------------------------


def test_packing(spark, docs):
    rows = [(i if i is not None else -1, t) for i, t in docs.dropDuplicates().collect()]
    rows.append((-20, "a <|endoftext|> b"))
    tokenizer = Tokenizer.from_file(f"{folder()}/byte_bpe_50k.json")
    ids = {i: [*tokenizer.encode(t or "", add_special_tokens=False).ids, 1] for i, t in rows}
    got = pack(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), byte_bpe()).collect()
    pieces, sequences, steps = defaultdict(list), defaultdict(list), defaultdict(set)
    for r in got:
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append(r)
        steps[r.step].add(r.tier)
    for i, own in ids.items():
        at = 0
        for r in sorted(pieces[i], key=lambda r: r.start):
            assert (r.start, r.doc_tokens) == (at, len(own)) and r.length > 0
            assert r.ids_crc32 == zlib.crc32(np.array(own[at : at + r.length], "<u4").tobytes())
            at += r.length
        assert at == len(own)
    for own in sequences.values():
        at = 0
        for r in sorted(own, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at == own[0].tier or own[0].tier == 256 > at, "only the last sequence of all may not be full"
        assert own[0].tier in (256, 512, 1024, 2048)
    assert sum(sum(r.length for r in own) < 256 for own in sequences.values()) <= 1
    assert {r.tier for r in got} == {256, 512, 1024, 2048}
    assert sorted(sequences) == list(range(len(sequences))) and sorted(steps) == list(range(len(steps)))
    assert all(len(tiers) == 1 for tiers in steps.values())


def test_rests_of_many_tasks_are_packed_together(spark, docs):
    """Of 40 tasks with a few short documents each, only one sequence isn't full."""
    short = docs.where("length(text) < 3000").repartition(40)
    got = pack(short, byte_bpe()).collect()
    lengths = defaultdict(int)
    for r in got:
        lengths[r.sequence_id, r.tier] += r.length
    assert sum(length < tier for (_, tier), length in lengths.items()) <= 1
    assert Counter(r.doc_id for r in got if r.start == 0) == Counter(r.doc_id for r in short.collect())


def test_packing_edge_cases(spark, docs):
    clash = pack(docs.limit(9).withColumnRenamed("doc_id", "tier"), byte_bpe(), key="tier")
    assert clash.columns[0] == "tier" and len(set(clash.columns)) == len(clash.columns) and clash.count() >= 9
    assert pack(docs.limit(0), byte_bpe()).count() == 0
    got = pack(spark.createDataFrame([(None, None), (1, ""), (1, "")], "doc_id long, text string"), byte_bpe()).collect()
    assert sum(r.length for r in got) == 3


# -- lexicon ----------------------------------------------------------------------------------------------------


def prose(draw, vocabulary, many):
    return [draw.choice(vocabulary) for _ in range(many)]


def test_texts_that_share_long_words_are_no_copies():
    draw = random.Random(11)
    shared = [f"frequentword{i}" for i in range(60)]
    texts = [(prose(draw, shared, 300) + ["zorg"] * (i % 4 == 0), int(i % 4 == 0)) for i in range(200)]
    assert len(toxicity.grouped(texts)) == 200
    assert toxicity.learn_terms(texts) == ["zorg"]


def test_near_copies_count_once():
    draw = random.Random(12)
    vocabulary = [f"{draw.choice('bcdfghklmnprst')}{i:05d}" for i in range(20_000)]
    base = prose(draw, vocabulary, 200)
    copies = [([*base[:i], f"edit{i}", *base[i + 1 :]], 1) for i in range(40)]
    others = [(prose(draw, vocabulary, 200), 0) for _ in range(40)]
    toxic = [([*prose(draw, vocabulary, 200), "zorg"], 1) for _ in range(10)]
    same_but_clean = (base, 0)
    groups = toxicity.grouped([*copies, *others, *toxic, same_but_clean])
    assert len(groups) == 1 + 40 + 10 + 1
    assert {"edit0", "edit39"} <= groups[0][0], "words of every copy count"
    assert toxicity.learn_terms([*copies, *others, *toxic]) == ["zorg"]


def test_held_out_recall(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{name}.parquet") for name in ("documents", "labels"))
    rows = toxicity.score(docs.select("doc_id", "text"), toxicity.fit(docs, labels)).join(labels, "doc_id").where("held_out")
    rows = rows.select("predicted", "toxic").where("toxic is not null").collect()
    toxic = [r.predicted for r in rows if r.toxic]
    assert len(toxic) > 50 and np.mean(toxic) >= 0.85
    assert np.mean([r.predicted == r.toxic for r in rows]) >= 0.95
    assert sum(r.predicted for r in rows if not r.toxic) <= 3
