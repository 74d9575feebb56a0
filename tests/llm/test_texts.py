"""Words, terms and pieces against plain regular expressions; byte-level BPE against the public library."""

import re

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from shelfmark.llm.bpe import Decoder, Encoder, Transducer, encode_texts, merged, read_ranks, token_digests
from shelfmark.llm.letters import terms_of
from shelfmark.llm.words import split_words, window_hashes

TEXTS = st.lists(st.text(alphabet=st.sampled_from("ab'sretvmldAB \n\t\x0b\x1c  0129é中　\x85!.\U0001f600ßÀÁ²Ⅷ"), max_size=40), min_size=1, max_size=8)
RANKS = read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
ENCODER = Encoder(RANKS)
LIBRARY = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})


@settings(max_examples=150, deadline=None)
@given(TEXTS)
def test_words_equal_the_pattern(texts):
    words = split_words(pa.array(texts))
    data = words.data.tobytes()
    for k, text in enumerate(texts):
        own = [data[a:b].decode() for a, b in zip(words.starts, words.ends)][words.first[k] : words.first[k + 1]]
        assert own == re.findall(r"[^\x20\x09-\x0D]+", text)
    by_text = {}
    spelled = [data[a:b] for a, b in zip(words.starts, words.ends)]
    for word, value in zip(spelled, words.hashes.tolist()):
        assert by_text.setdefault(word, value) == value
    assert len(set(by_text.values())) == len(by_text)


@pytest.mark.parametrize("width", [3, 15, 35])
def test_window_hashes_are_equal_where_the_words_are(width):
    rng = np.random.default_rng(1)
    words = [f"w{x}" for x in rng.integers(0, 2, 400)]
    hashes = window_hashes(split_words(pa.array([" ".join(words)])).hashes, width)
    seen = {}
    for k, value in enumerate(hashes.tolist()):
        assert seen.setdefault(tuple(words[k : k + width]), value) == value
    assert len(set(seen.values())) == len(seen) and len(hashes) == 400 - width + 1


@settings(max_examples=100, deadline=None)
@given(TEXTS)
def test_terms_are_lower_cased_letter_runs(texts):
    hashes, text = terms_of(pa.array(texts))
    for k, body in enumerate(texts):
        low = "".join(c.lower() if len(c.lower()) == 1 else c for c in body)
        runs = re.findall(r"[^\W\d_]+", "".join(c if c.isalpha() else " " for c in low))
        assert [terms_of(pa.array([x]))[0][0] for x in runs] == hashes[text == k].tolist()


@settings(max_examples=200, deadline=None)
@given(TEXTS)
def test_encoding_equals_the_library(texts):
    for text, ids in zip(texts, ENCODER.encode(pa.array(texts))):
        assert np.frombuffer(ids, "<u4").tolist() == LIBRARY.encode_ordinary(text)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(max_size=30), min_size=1, max_size=4), st.integers(1, 5))
def test_decoding_gives_the_text_back_in_whole_characters(texts, block):
    for text, ids in zip(texts, ENCODER.encode(pa.array(texts))):
        parts = list(Decoder(RANKS).decode(np.frombuffer(ids, "<u4"), block))
        assert b"".join(parts) == text.encode() and [p.decode() for p in parts]


def test_long_pieces_and_merges():
    for text in ("a" * 3000, "ab" * 2000 + "zq" * 100, "é" * 1500, " " * 500):
        (ids,) = ENCODER.encode(pa.array([text]))
        assert np.frombuffer(ids, "<u4").tolist() == LIBRARY.encode_ordinary(text)
    assert merged(b"", RANKS) == [] and b"".join(merged(b"hello", RANKS)) == b"hello"


def test_a_small_state_table_changes_nothing(monkeypatch):
    from shelfmark.llm import bpe

    monkeypatch.setattr(bpe, "MOST_STATES", 5)
    monkeypatch.setattr(bpe, "MOST_PIECES", 3)
    text = "There were thousands of unrelated pieces, weren't there? " * 3
    (ids,) = Encoder(RANKS).encode(pa.array([text]))
    assert np.frombuffer(ids, "<u4").tolist() == LIBRARY.encode_ordinary(text)


def test_tokens_that_may_follow_are_those_that_merging_gives():
    import random

    for seed in range(60):
        rng, ranks = random.Random(seed), {b"a": 0, b"b": 1, b"c": 2}
        while len(ranks) < (8, 16, 30)[seed % 3]:
            token = rng.choice(list(ranks)) + rng.choice(list(ranks))
            if len(token) < 12:
                ranks.setdefault(token, len(ranks))
        if seed % 2:  # ids that don't go by the order of merges
            ranks = dict(zip(ranks, rng.sample(range(len(ranks)), len(ranks))))
        transducer = Transducer(ranks)
        for left in ranks:
            for right in ranks:
                assert transducer.may_follow(left, right) == (merged(left + right, ranks) == [left, right])


def test_a_token_is_merged_twice_at_most_whatever_it_follows(monkeypatch):
    from shelfmark.llm import bpe

    texts = []
    monkeypatch.setattr(bpe, "merged", lambda text, *more: (texts.append(text), merged(text, *more))[1])
    (ids,) = Encoder(RANKS).encode(pa.array(["unrelated " + " ".join(f"{a}{b}{c}" for a in "abcdefgh" for b in "xyzuvw" for c in ("ing", "er", "zzq"))]))
    assert ids and max(map(texts.count, texts)) <= 2 and all(text in RANKS for text in texts)


def test_broken_bytes_wait_until_the_end():
    decoder = Decoder({bytes([b]): b for b in range(256)})
    assert decoder.feed(np.array([0xE4, 0xB8])) == b"" and decoder.feed(np.array([0xAD, 0x41])) == "中A".encode()
    assert decoder.feed(np.array([0xF0])) == b"" and decoder.end() == b"\xf0"


def test_encoding_of_tables(spark):
    rows = spark.createDataFrame([(1, "It's  a test"), (2, None), (3, ""), (3, "It's  a test"), (None, "é")], "doc_id long, text string")
    found = {(r.doc_id, r.decoded): r.token_ids for r in encode_texts(rows, RANKS).collect()}
    assert found[1, "It's  a test"] == LIBRARY.encode_ordinary("It's  a test") == found[3, "It's  a test"]
    assert found[2, ""] == [] and found[3, ""] == [] and found[None, "é"] == LIBRARY.encode_ordinary("é")
    assert token_digests(rows, RANKS).count() == 5 and token_digests(rows.limit(0), RANKS).count() == 0
