"""Packing: exact round trip, capacity, gapless offsets, little padding."""

import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from shelfmark.llm.packing import Packer, differencing, fitting, pack_documents

PATH = public_tokenizers.path("byte_bpe_50k.json")


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 16), min_size=1, max_size=60), st.integers(1, 8))
def test_differencing_spreads_evenly(sizes, windows):
    sums = np.bincount(differencing(sizes, windows), sizes, windows)
    assert sums.sum() == sum(sizes) and sums.max() - sums.min() <= max(sizes)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 16), min_size=1, max_size=60))
def test_windows_rise_until_all_fit(sizes):
    dealt = fitting(sizes, 16)
    assert sorted(i for parts in dealt for i in parts) == list(range(len(sizes)))
    assert all(sum(sizes[i] for i in parts) <= 16 for parts in dealt)


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(1, 400), max_size=80))
def test_pieces_cover_every_document(lengths):
    packer, docs = Packer(64, 5), [np.arange(n, dtype=np.uint32) for n in lengths]
    for doc, ids in enumerate(docs):
        packer.add(doc, ids)
    packer.close()
    check(packer.take(), dict(enumerate(docs)), 64)


def check(rows, docs, capacity):
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for doc, start, length, crc, whole, sequence, offset in rows:
        ids = docs[doc]
        assert whole == len(ids) and length > 0 and crc == zlib.crc32(ids[start : start + length].astype("<u4").tobytes())
        by_doc[doc].append((start, length))
        by_sequence[sequence].append((offset, length))
    for spans, ends in [(by_doc, {d: len(x) for d, x in docs.items()}), (by_sequence, None)]:
        for key, parts in spans.items():
            at = 0
            for start, length in sorted(parts):
                assert start == at
                at += length
            assert at == ends[key] if ends else at <= capacity
    assert by_doc.keys() == docs.keys()
    return by_sequence


def test_documents_of_a_table(spark):
    rng = np.random.default_rng(2)
    texts = [" ".join(f"word{x}" for x in rng.integers(0, 999, n)) for n in rng.integers(0, 900, 150)]
    texts += [None, "", "a <|endoftext|> b", "x " * 9000, texts[0]]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    found = pack_documents(rows, PATH, public_tokenizers.PATTERN)
    assert found.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    tokenizer = Tokenizer.from_file(PATH)
    docs = {k: np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 1], np.uint32) for k, t in enumerate(texts)}
    sequences = check([tuple(r) for r in found.collect()], docs, 2048)
    total = sum(len(x) for x in docs.values())
    assert len(sequences) <= total / 2048 * 1.05 + 3
    assert pack_documents(rows.limit(0), PATH, public_tokenizers.PATTERN).count() == 0
