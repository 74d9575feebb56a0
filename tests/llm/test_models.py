"""Language and toxicity: their parts against brute force, held-out accuracy, and edge cases."""

from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from shelfmark.llm import language, queries, toxicity
from shelfmark.llm.language import BLOCK, Parser, SuffixAutomaton, identify_languages, spelled
from shelfmark.llm.letters import terms_of
from shelfmark.llm.toxicity import BlockIndex, Vocabulary, reject_toxic, score_toxicity

FOLDER = "/root/testdata/sf0.01"
LARGER = "/root/testdata/sf0.1"  # the smaller table has six toxic documents that are held out
needs_tables = pytest.mark.skipif(not Path(FOLDER).exists(), reason="no shared tables")


@settings(max_examples=100, deadline=None)
@given(st.text("abc", max_size=30), st.text("abcd", max_size=6))
def test_the_automaton_knows_every_substring(sample, text):
    arcs, state = SuffixAutomaton([ord(c) for c in sample]).arcs, 0
    for c in text:
        state = None if state is None else arcs[state].get(ord(c))
    assert (state is not None) == (text in sample)


def phrases(sample, text):
    """Longest matches one after the other; a symbol that the sample lacks is a phrase."""
    n = at = 0
    while at < len(text):
        end = at + 1
        while end <= len(text) and text[at:end] in sample:
            end += 1
        at, n = max(at + 1, end - 1), n + 1
    return n


@settings(max_examples=60, deadline=None)
@given(st.text("abc ", min_size=4, max_size=60), st.lists(st.text("abcX1, ", max_size=40), min_size=1, max_size=4))
def test_entropies_equal_longest_match_parsing(sample, texts):
    symbols, _ = spelled(pa.array([sample]))
    if len(symbols) < 2:
        return
    parser = Parser({"l": symbols})
    bits, counts = parser.entropies(pa.array(texts))
    inner = "".join(map(chr, symbols)).replace("\0", " ")
    for text, row, n in zip(texts, bits, counts):
        own, _ = spelled(pa.array([text]))
        body = "".join(map(chr, own)).replace("\0", " ")
        assert n == len(body)
        if n:
            assert row[0] == pytest.approx(phrases(inner, body) * np.log2(len(symbols)) / n)


def test_long_texts_are_parsed_in_blocks():
    sample = "the quick brown fox jumps over the lazy dog again and again "
    parser = Parser({"l": spelled(pa.array([sample]))[0]})
    text = "a lazy fox and a quick dog jump " * 200
    own = "".join(map(chr, spelled(pa.array([text]))[0])).replace("\0", " ")
    want = sum(phrases(sample, own[k : k + BLOCK]) for k in range(0, len(own), BLOCK))
    bits, counts = parser.entropies(pa.array(["x", text, ""]))
    assert counts.tolist()[1:] == [len(own), 0] and bits[1, 0] == pytest.approx(want * parser.bits[0] / len(own))


def test_languages_of_a_table(spark):
    learned = spark.createDataFrame(
        [(1, "the cat and the dog are in the house", "en"), (2, "der Hund und die Katze sind im Haus", "de"), (3, "??", "xx"), (4, None, "yy"), (5, "le chat", None)],
        "doc_id long, text string, lang string",
    )
    rows = spark.createDataFrame([(1, "the house and the cat"), (2, "Die Katze und der Hund"), (3, None), (4, " 12 !"), (5, ""), (None, "the dog"), (1, "the dog")], "doc_id long, text string")
    found = identify_languages(rows, learned).collect()
    assert [(r.doc_id, r.lang_pred) for r in found] == [(1, "en"), (2, "de"), (3, "und"), (4, "und"), (5, "und"), (None, "en"), (1, "en")]
    assert all(0 <= r.score <= 1 for r in found) and set(found[0].entropies) == {"en", "de"}
    assert {r.lang_pred for r in identify_languages(rows, learned.limit(0)).collect()} == {"und"}
    assert identify_languages(rows.limit(0), learned).count() == 0


@needs_tables
def test_languages_of_held_out_documents(spark):
    found = queries.QUERIES["op2_language"](spark, FOLDER).join(spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "lang"), "doc_id")
    right, n = found.filter("held_out AND lang IS NOT NULL").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")), F.count(F.lit(1))).first()
    assert n > 200 and right > 0.98


def index_of(vectors, labels, rate=0.3):
    names = [f"t{k}" for k in range(vectors.shape[1])]
    hashes = np.array([terms_of(pa.array([x]))[0][0] if terms_of(pa.array([x]))[0].size else 0 for x in names])
    return BlockIndex(np.arange(len(labels)) * 3 + 1, labels, vectors, Vocabulary(names, hashes, np.ones(len(names)), np.ones(len(names))), rate)


@pytest.mark.parametrize("seed,block", [(1, 64), (2, 4), (3, 1)])
def test_the_block_index_finds_exactly_the_nearest(monkeypatch, seed, block):
    monkeypatch.setattr(toxicity, "BLOCK", block)
    rng = np.random.default_rng(seed)
    vectors = rng.integers(0, 3, (90, 12)) * (rng.random((90, 12)) < 0.25)
    vectors = vectors / np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-300)
    index = index_of(vectors, rng.integers(0, 2, 90))
    asked = vectors[rng.permutation(90)[:40]]
    best, place = index.nearest(asked, 7)
    own = index.weights.T
    for query, scores, places in zip(asked, best, place):
        every = np.round(own @ query, 12)
        order = [k for k in np.lexsort((index.ids, -every)) if every[k] > 0][:7]
        assert [p for p in places if p >= 0] == order and scores[: len(order)].tolist() == every[order].tolist()


def test_toxicity_of_a_table(spark):
    rng = np.random.default_rng(5)
    rows, labels = [], []
    for k in range(240):
        words = [f"w{'abcdefgh'[x]}{'ijklmnop'[y]}" for x, y in rng.integers(0, 8, (30, 2))]
        bad = k % 4 == 0
        rows.append((k, " ".join(words + ["awful", "nasty"] * bad), "x"))
        labels.append((k, int(bad)))
    rows += [(900, None, "x"), (901, "", "x"), (902, "zzz", "x"), (903, "Nasty, awful!", "x"), (None, "awful", "x"), (0, rows[0][1], "x")]
    documents = spark.createDataFrame(rows, "doc_id long, text string, score string")
    marks = spark.createDataFrame([*labels, (5000, 1), (7, None)], "doc_id long, toxic int")
    found = {(r.doc_id, r.score): r for r in score_toxicity(documents, marks).collect()}
    by = {doc: r for (doc, _), r in found.items()}
    assert all(by[k].predicted == bad for k, bad in labels) and by[903].predicted == 1 and by[None].predicted == 1
    assert by[900].score == by[901].score == by[902].score < 0.5 and by[900].neighbours == [] and set(by[903].evidence) == {"awful", "nasty"}
    assert all(n.label == 1 for n in by[903].neighbours) and len(by[903].neighbours) > 5
    clean = reject_toxic(documents, marks)
    assert clean.columns == documents.columns and clean.count() == 180 + 3
    none = score_toxicity(documents, marks.limit(0))
    assert none.filter("predicted = 1").count() == 0 and score_toxicity(documents.limit(0), marks).count() == 0
    assert score_toxicity(documents, marks.filter("toxic = 0")).filter("predicted = 1").count() == 0


def test_examples_are_chosen_in_every_task(spark, monkeypatch):
    rows = spark.range(400).selectExpr("id AS doc_id", "concat('text ', id) AS text", "cast(id % 4 = 0 AS int) AS toxic")
    chosen, rate = toxicity.examples_of(rows, rows, "doc_id", "text", "toxic")
    plan = chosen._jdf.queryExecution().executedPlan().toString()
    assert plan.count("TakeOrderedAndProject") == 2 and "Window" not in plan and chosen.count() == 400 and rate == 0.25
    monkeypatch.setattr(toxicity, "EXAMPLES", 30)
    chosen, _ = toxicity.examples_of(rows, rows, "doc_id", "text", "toxic")
    hashes = rows.select("toxic", "doc_id", F.xxhash64("text").alias("h")).collect()
    want = {r.doc_id for k in (0, 1) for r in sorted((x for x in hashes if x.toxic == k), key=lambda x: (x.h, x.doc_id))[:30]}
    assert {r.id for r in chosen.collect()} == want


def test_rare_wordings_have_neighbours(spark):
    rng = np.random.default_rng(9)
    rows, labels = [], []
    for k in range(200):
        words = [f"w{'abcdefgh'[x]}{'ijklmnop'[y]}" for x, y in rng.integers(0, 8, (20, 2))]
        bad = k % 4 == 0
        rows.append((k, " ".join(words + ["awful", "nasty"] * bad)))
        labels.append((k, int(bad)))
    rare = "you brainless crooked vermin crawl back beneath your filthy rotten swamp".split()
    rows += [(300, " ".join(rare + rows[1][1].split()[:3])), (301, "seldom heard gentle melodies drift over quiet meadows at dusk")]
    labels += [(300, 1), (301, 0)]
    rows += [(400, " ".join(rare[:-2] + rows[2][1].split()[:2])), (401, "gentle melodies drift over quiet meadows"), (402, "...")]
    documents = spark.createDataFrame(rows, "doc_id long, text string")
    marks = spark.createDataFrame(labels, "doc_id long, toxic int")
    by = {r.doc_id: r for r in score_toxicity(documents, marks).collect()}
    assert by[400].predicted == 1 and by[400].neighbours[0].id == 300 and by[400].neighbours[0].cosine > 0.7
    assert by[401].predicted == 0 and by[401].neighbours[0].id == 301 and "meadows" in by[401].evidence
    assert [k for k, r in by.items() if not r.neighbours] == [402]
    assert not {300, 400} & {r.doc_id for r in reject_toxic(documents, marks).collect()}
    # the rate of the blank examples is not held below a half
    blank = BlockIndex(np.arange(4), np.array([1, 1, 1, 0]), np.array([[0.0], [0.0], [0.0], [1.0]]), Vocabulary(["a"], np.zeros(1), np.ones(1), np.ones(1)), 0.75)
    assert blank.blank > 0.5


@pytest.mark.skipif(not Path(LARGER).exists(), reason="no shared tables")
def test_toxicity_of_held_out_documents(spark):
    found = queries.QUERIES["op1_toxicity"](spark, LARGER).join(spark.read.parquet(f"{LARGER}/labels.parquet"), "doc_id").filter("held_out")
    counts = {(r.toxic, r.predicted): r.n for r in found.groupBy("toxic", "predicted").agg(F.count(F.lit(1)).alias("n")).collect()}
    good = counts.get((1, 1), 0)
    assert good >= 0.85 * (good + counts.get((1, 0), 0)) and counts.get((0, 1), 0) <= 0.02 * counts[0, 0]


def test_samples_are_bounded_and_come_from_whole_texts(spark, monkeypatch):
    monkeypatch.setattr(language, "STRETCHES", 5)
    monkeypatch.setattr(language, "STRETCH", 20)
    # every text begins with the same foreign header; what tells the language stands far behind it
    head = "lorem ipsum dolor sit amet consectetur " * 60
    rows = spark.createDataFrame([(f"{head} nummer {'abcdefghij'[k % 10]} {'und noch mehr davon ' * 40}", "de") for k in range(30)] + [(None, "de"), ("x y", None), ("...", "fr")], "text string, lang string")
    samples = {r["lang"]: r["parts"] for r in language.sample_languages(rows, "text", "lang").collect()}
    assert list(samples) == ["de"] and len(samples["de"]) == len(set(samples["de"])) == 5 and all(len(x) <= 20 for x in samples["de"])
    monkeypatch.setattr(language, "STRETCHES", 64)
    parts = language.sample_languages(rows, "text", "lang").first()["parts"]
    assert any("mehr" in x or "davon" in x for x in parts) and any("dolor" in x or "amet" in x for x in parts)


def test_any_number_of_languages_in_groups(spark, monkeypatch):
    letters = "abcdefghijklmnopqrstuvwxyz"
    rng = np.random.default_rng(4)
    learned = [(k, " ".join("".join(letters[x] for x in word) for word in rng.integers(0, 26, (40, 4))), f"l{k:02}") for k in range(70)]
    texts = [(k, text[30:90]) for k, text, _ in learned] + [(3, "abc"), (None, "abc def"), (200, None), (201, "..."), (None, None)]
    labelled = spark.createDataFrame(learned, "doc_id long, text string, lang string")
    rows = spark.createDataFrame(texts, "doc_id long, text string").withColumn("key", F.lit("x")).withColumn("best", F.lit(1))

    def found():
        return sorted(((r.doc_id, r.lang_pred, round(r.score, 12), sorted(r.entropies.items())) for r in identify_languages(rows, labelled).collect()), key=str)

    grouped = found()
    monkeypatch.setattr(language, "TOGETHER", 100)
    assert grouped == found() and len(grouped) == len(texts) and {x[1] for x in grouped if x[0] in (200, 201)} == {"und"}
    assert sum(x[1] == f"l{x[0]:02}" for x in grouped if x[0] is not None and x[0] < 70) >= 65


@needs_tables
def test_the_nearest_equal_plain_vectors_and_blocks_are_skipped(spark):
    """Term counts, document frequencies, weights and cosines are computed anew here from the texts."""
    import collections
    import hashlib
    import math

    import regex

    documents = spark.read.parquet(f"{LARGER}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{LARGER}/labels.parquet").filter("doc_id % 5 <> 0")
    index = toxicity.fit(documents, labels)
    own = {r.doc_id: r.text or "" for r in documents.collect()}
    fold = lambda x: "".join(c.lower() if len(c.lower()) == 1 else c for c in x)
    counted = {k: collections.Counter(fold(m) for m in regex.findall(r"\p{L}+", t)) for k, t in own.items()}
    frequency = collections.Counter(t for c in counted.values() for t in c)
    examples = [int(x) for x in index.ids]

    def weight(t):
        return math.log((1 + len(own)) / (1 + frequency[t])) + 1

    known = set().union(*(counted[k] for k in examples))

    def vector(k):
        x = {t: (1 + math.log(n)) * weight(t) for t, n in counted[k].items() if t in known}
        length = math.sqrt(sum(v * v for v in x.values())) or 1.0
        return {t: v / length for t, v in x.items()}

    vectors = [vector(k) for k in examples]
    assert [hashlib.sha256(own[k].encode()).hexdigest() for k in examples] == sorted(hashlib.sha256(own[k].encode()).hexdigest() for k in examples)
    asked = sorted(own)[::400]
    index.read = index.blocks = 0
    _, best, place, _ = index.score(pa.array([own[k] for k in asked]))
    for k, scores, places in zip(asked, best, place):
        mine = vector(k)
        every = np.array([sum(v * x.get(t, 0.0) for t, v in mine.items()) for x in vectors])
        n = min(len(scores), int((every > 1e-12).sum()))
        assert scores[:n] == pytest.approx(np.sort(every)[::-1][:n], abs=1e-9)
        assert every[places[:n]] == pytest.approx(scores[:n], abs=1e-9)
    assert index.read < 0.7 * index.blocks  # with blocks of twelve half of them are left out, at twice the time


def test_ids_have_no_say_in_ties(spark):
    texts = [f"word{k % 7} shared term number{k}" for k in range(60)]
    labels = [k % 2 for k in range(60)]

    def scores(ids):
        documents = spark.createDataFrame(list(zip(ids, texts)), "doc_id long, text string")
        known = spark.createDataFrame(list(zip(ids, labels)), "doc_id long, toxic int")
        asked = spark.createDataFrame([(1, "shared term"), (2, "word3 term")], "doc_id long, text string")
        return {r.doc_id: r.score for r in score_toxicity(asked, known, documents).collect()}

    assert scores(range(60)) == scores(range(60, 0, -1))
