"""The pipeline stage by stage against brute force, on a folder of planted documents."""

import random
import re
from collections import defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from shelfmark.llm.jaccard import Similarity
from shelfmark.llm.secrets import redacted, secret_spans
from shelfmark.llm.toxicity import NEAREST, Rows, fit
from tests.llm.test_packing import PATH, check
from tests.llm.test_passages import cut, groups


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rng = random.Random(11)
    vocabulary = [f"{a}{b}{c}" for a in "bdfglm" for b in "aeiou" for c in "nrst"]
    passage = [rng.choice(vocabulary) for _ in range(60)]
    rows, labels = [], []
    for k in range(160):
        words = [rng.choice(vocabulary) for _ in range(rng.randint(0, 150))]
        if k % 4 == 0:
            words += ["vile", "hateful", "vile"]
        if k % 7 == 1:
            words[len(words) // 2 : len(words) // 2] = passage
        if k % 9 == 2:
            words += ["token", "=", "abcdef0123456789"]
        rows.append((k, " ".join(words), "en", "src", 1))
        labels.append((k, 1, int(k % 4 == 0)))
    for k in range(160, 190):
        words = rows[k % 20 + 1][1].split()
        for _ in range(rng.randint(0, 2)):
            words.insert(rng.randrange(len(words) + 1), "inserted")
        rows.append((k, " ".join(words), None, None, None))
    rows += [(190, None, "en", "src", 0), (191, "", "en", "src", 0), (192, rows[5][1], None, "other", 3), (192, rows[5][1], None, "other", 3), (None, rows[6][1], "en", "src", 1)]
    rows += [(193, "lone " * 3000, "en", "src", 1)]
    path = str(tmp_path_factory.mktemp("tables"))
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return path


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_the_stages_are_the_dealt_ones():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "near_duplicates", "passages", "secrets", "packing"]


def test_every_stage_equals_brute_force(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    stages = [f for _, f in corpus_pipeline.STAGES]
    columns = docs.columns

    # toxicity: every cosine computed
    kept = corpus_pipeline.written(stages[0](spark, docs, folder))
    index = fit(docs, spark.read.parquet(f"{folder}/labels.parquet"))
    import pyarrow as pa

    want = []
    for row in docs.collect():
        query = index.vocabulary.vectors(pa.array([row.text or ""]))[0]
        cosines = np.round(index.weights.T @ query, 12)
        order = [k for k in np.lexsort((np.arange(len(cosines)), -cosines)) if cosines[k] > 0][:NEAREST]
        vote = index.votes(Rows.of_dense(query[None, :]), np.array([order], int)) if order else None
        if (np.interp(vote, *index.curve)[0] if order else index.blank) < 0.5:
            want.append(tuple(row))
    assert kept.columns == columns and rows_of(kept) == sorted(want, key=repr)
    assert not [r for r in want if "vile" in (r[1] or "")] and len(want) > 120

    # near duplicates: every pair compared
    single = corpus_pipeline.written(stages[1](spark, kept, folder))
    rows = kept.collect()
    classes = defaultdict(list)
    for k, (_, low) in groups([r.text for r in rows], Similarity()).items():
        classes[low].append(rows[k])
    left = single.collect()
    assert single.columns == columns and len(left) == len(classes)
    assert all(sum(tuple(r) in set(map(tuple, left)) for r in set(map(tuple, own))) == 1 for own in classes.values())

    # passages: every window counted
    shorter = corpus_pipeline.written(stages[2](spark, single, folder))
    rows = single.collect()
    want = []
    for row, (_, gone, text) in zip(rows, cut([r.text for r in rows])):
        text = text if gone else row.text
        want.append((row.doc_id, text, row.lang, row.source, None if text is None else len(text)))
    assert shorter.columns == columns and rows_of(shorter) == sorted(want, key=repr)

    # secrets: the plain patterns
    clean = corpus_pipeline.written(stages[3](spark, shorter, folder))
    assert clean.columns == columns and not [r for r in clean.collect() if re.search("token = [a-z0-9]{6}", r.text or "")]
    want = []
    for row in shorter.collect():
        text = None if row.text is None else redacted(row.text, next(secret_spans([row.text])))
        want.append((row.doc_id, text, row.lang, row.source, None if text is None else len(text)))
    assert rows_of(clean) == sorted(want, key=repr)

    # packing: every id once
    packed = stages[4](spark, clean, folder).collect()
    tokenizer = Tokenizer.from_file(PATH)
    texts = {r.doc_id: r.text for r in clean.collect()}
    check([tuple(r) for r in packed], {k: np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 1], np.uint32) for k, t in texts.items()}, 2048)

    # the whole run gives the same pieces, but for the order in which tasks met them
    again = corpus_pipeline.run(spark, folder)
    assert again.count() > 0 and {r.doc_id for r in again.select("doc_id").collect()} == set(texts)


def test_an_empty_table_runs_through(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.written(stage(spark, docs, folder))
    assert docs.count() == 0
