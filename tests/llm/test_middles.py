"""Fill-in-middle forms against slicing the list of units."""

import hashlib
import re

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from shelfmark.llm import middles
from shelfmark.llm.middles import Fenwick, Texts, fill_in_middle, restored, transform

UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")
TEXTS = st.lists(st.text(alphabet=st.sampled_from("ab<>PSM \n\t\x0b\x1c\x85é中　\U0001f600"), max_size=60), min_size=1, max_size=8)


def slow(text, id, seed=42, rate=50, spm=80):
    text = text or ""
    units = UNIT.findall(text)
    digest = hashlib.sha256(f"{seed}:{'' if id is None else id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[k : k + 8], 16) for k in (0, 8, 16, 24))
    n = len(units)
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h3 % 100 >= rate:
        return n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = ("".join(x) for x in (units[:a], units[a:b], units[b:]))
    if h4 % 100 < spm:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


@given(st.lists(st.tuples(st.integers(0, 4), st.integers(0, 9)), min_size=1, max_size=40))
def test_descent_equals_counting(counts):
    tree = Fenwick(np.array(counts))
    unit = 0
    for block, (units, _) in enumerate(counts):
        for number in range(1, units + 1):
            unit += 1
            assert tree.descend(unit) == (block, number, sum(p for _, p in counts[:block]))


@settings(max_examples=200, deadline=None)
@given(TEXTS, st.sampled_from([1, 3, 512]), st.integers(0, 50))
def test_forms_equal_slicing(texts, block, first):
    old, middles.BLOCK = middles.BLOCK, block
    try:
        ids = list(range(first, first + len(texts)))
        out = [(*x[:4], x[4].decode()) for x in transform(pa.array(texts), ids, 42, 90, 50)]
        cuts = [[Texts(pa.array(texts)).cut(k, Texts(pa.array(texts)).tree(k), u)[1] for u in range(len(UNIT.findall(t)) + 1)] for k, t in enumerate(texts) if t]
    finally:
        middles.BLOCK = old
    assert out == [slow(t, id, rate=90, spm=50) for t, id in zip(texts, ids)]
    lengths = [[0, *np.cumsum([len(u) for u in UNIT.findall(t)]).tolist()] for t in texts if t]
    assert cuts == lengths


@pytest.mark.parametrize("rate,spm", [(50, 80), (100, 0), (100, 100), (0, 50)])
def test_rows_equal_slicing_and_are_restored(spark, rate, spm):
    texts = ["one two  three\n", "", None, " \t ", "é" * 700 + " 中 x" * 300, "has <P> in it", "<P <S", "word " * 60_000, "x", "a　b\x85c d"]
    rows = [(k, t, "n") for k, t in enumerate(texts)] + [(None, "no id at all", "m"), (3, "same id", "m"), (3, "same id", "m")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n string").repartition(3)
    out = fill_in_middle(docs, rate=rate, spm_rate=spm)
    assert out.columns == ["doc_id", "text", "n", "n_", "form", "prefix_chars", "middle_chars"]
    key = lambda r: tuple(map(str, r))
    got = sorted(((r.doc_id, r.n, r.n_, r.form, r.prefix_chars, r.middle_chars, r.text) for r in out.collect()), key=key)
    assert got == sorted(((id, own, *slow(t, id, rate=rate, spm=spm)) for id, t, own in rows), key=key)
    back = out.select("doc_id", restored(F.col("text"), F.col("form")).alias("t")).collect()
    assert sorted((str(r.doc_id), r.t) for r in back) == sorted((str(id), t or "") for id, t, _ in rows)


def test_empty_table_and_other_columns(spark):
    docs = spark.createDataFrame([("a", 1, ["x"])], "text string, doc_id int, more array<string>")
    assert fill_in_middle(docs.limit(0)).count() == 0
    assert fill_in_middle(docs).first().more == ["x"]
