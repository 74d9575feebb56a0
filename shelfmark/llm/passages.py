"""Passages that occur more than once, found by anchors at the positions of a difference cover.

A window is a run of ``width`` words. In a difference cover of a period every difference of two positions is a difference
of two cover positions. So wherever two equal windows lie, some offset below the period puts both at cover positions,
and the shorter anchor window that starts there is equal too and lies inside both. Only anchors are shuffled; windows
around a repeated anchor are then extended to their whole width and compared.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.places import Places, ranges_for, repeated_places
from shelfmark.llm.tables import free_name, row_keys, slices, written
from shelfmark.llm.words import U, Words, split_words, window_hashes

WIDTH = 35
# Positions whose differences give every number modulo the period (fixed values: a perfect difference set).
PERIOD, COVER = 21, (0, 1, 4, 14, 16)


def anchor_width(width: int) -> int:
    """Words of an anchor: the window without the offsets that may precede it."""
    if width < PERIOD:
        raise ValueError(f"windows have at least {PERIOD} words")
    return width - PERIOD + 1


def in_text(words: Words, width: int) -> np.ndarray:
    """Word positions (of all texts) where a run of ``width`` words of one text begins."""
    n = max(0, len(words.hashes) - width + 1)
    last = np.repeat(words.first[1:], words.counts())[:n]
    return np.flatnonzero(np.arange(n) + width <= last)


def text_of(words: Words) -> np.ndarray:
    """Text number of each word."""
    return np.repeat(np.arange(len(words.first) - 1), words.counts())


def _anchors(width: int) -> Callable[[pa.RecordBatch], Iterator[Places]]:
    """Anchors of a batch of texts, at cover positions."""
    cover = np.zeros(PERIOD, bool)
    cover[list(COVER)] = True
    size = anchor_width(width)

    def of(batch: pa.RecordBatch) -> Iterator[Places]:
        for part, texts in slices(batch):
            words = split_words(texts)
            long = np.repeat(words.counts() >= width, words.counts())
            text = text_of(words)
            at = in_text(words, size)
            place = at - words.first[text[at]]
            keep = cover[place % PERIOD] & long[at]
            at, place = at[keep], place[keep]
            hashes = window_hashes(words.hashes, size, 1)[at] if len(at) else np.zeros(0, U)
            yield hashes, np.zeros(len(at), U), part.column("doc").to_numpy(zero_copy_only=False)[text[at]], place

    return of


def _packed(rows: DataFrame) -> DataFrame:
    """(doc, body): compressed texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            bodies = [press.compress((x or "").encode()) for x in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc"), pa.array(bodies, pa.binary())], ["doc", "body"])

    return rows.select("doc", "text").mapInArrow(run, "doc long, body binary")


def _opened(bodies: pa.Array) -> pa.Array:
    unpress = zstandard.ZstdDecompressor()
    return pa.array([unpress.decompress(x) for x in bodies.to_pylist()], pa.binary()).cast(pa.string())


def _windows(width: int) -> Callable[[pa.RecordBatch], Iterator[Places]]:
    """Windows of a batch of candidates (doc, anchors, body) that hold one of the text's repeated anchors."""
    reach = width - anchor_width(width)

    def of(batch: pa.RecordBatch) -> Iterator[Places]:
        whole = pa.RecordBatch.from_arrays([batch.column("doc"), batch.column("anchors"), _opened(batch.column("body"))], ["doc", "anchors", "text"])
        for part, texts in slices(whole):
            words = split_words(texts)
            begins = np.zeros(len(words.hashes) + 1, np.int64)
            for first, anchors in zip(words.first, part.column("anchors").to_pylist()):
                at = np.array(anchors)
                np.add.at(begins, first + np.maximum(0, at - reach), 1)
                np.add.at(begins, first + at + 1, -1)
            at = in_text(words, width)
            at = at[(np.cumsum(begins)[:-1] > 0)[at]]
            text = text_of(words)[at]
            if len(at):
                h1, h2 = (window_hashes(words.hashes, width, seed)[at] for seed in (2, 3))
                yield h1, h2 >> U(32), part.column("doc").to_numpy(zero_copy_only=False)[text], at - words.first[text]

    return of


def repeated_windows(rows: DataFrame, width: int = WIDTH) -> tuple[DataFrame, DataFrame]:
    """((doc, starts array<int>): where windows that occur more than once begin; (doc, body): texts of the candidates).

    Windows are compared by 96 bits of their hashes. Documents without such a window are left out.
    """
    ranges = ranges_for(rows)
    anchors = repeated_places(rows, _anchors(width), ranges).groupBy("doc").agg(F.collect_list("at").alias("anchors"))
    candidates = written(anchors.join(_packed(rows), "doc").select("doc", "anchors", "body"))
    starts = repeated_places(candidates, _windows(width), ranges, second=True).groupBy("doc").agg(F.collect_list("at").alias("starts"))
    return starts, candidates.select("doc", "body")


def _kept(texts: pa.Array, starts: list[list[int] | None], width: int) -> Iterator[tuple[int, int, bytes]]:
    """For each text: its words, how many are removed, the others joined by one space."""
    words = split_words(texts)
    gone = np.zeros(len(words.hashes) + 1, np.int64)
    for k, own in enumerate(starts):
        if own:
            at = np.array(own) + words.first[k]
            np.add.at(gone, at, 1)
            np.add.at(gone, at + width, -1)
    keep = np.cumsum(gone)[:-1] == 0
    data = words.data.tobytes()
    for a, b in zip(words.first[:-1].tolist(), words.first[1:].tolist()):
        index = a + np.flatnonzero(keep[a:b])
        kept = b" ".join([data[i:j] for i, j in zip(words.starts[index].tolist(), words.ends[index].tolist())])
        yield b - a, b - a - len(index), kept


def remove_repeated(documents: DataFrame, width: int = WIDTH, id: str = "doc_id", text: str = "text", digest: bool = False) -> DataFrame:
    """(id, n_words, n_removed, kept): each text without the words that a repeated window covers.

    A window is ``width`` consecutive words (runs without white space) of one document; it is repeated when the same words
    begin anywhere else, also in the same document. ``kept`` is the remaining words joined by one space, or with ``digest``
    their SHA-256 (``kept_sha256``). Null texts have no words; an empty table gives no rows; each row is a document of its
    own, whatever its id (also null), so repeated rows remove each other's words. Texts without a repeated anchor are
    finished in the first scan; only the others are shuffled, compressed.
    """
    keyed = row_keys(documents.select(documents[id].alias("own"), documents[text].cast("string").alias("text")), "own", "doc")
    rows = keyed.select("doc", "text")
    starts, candidates = repeated_windows(rows, width)
    found = written(starts.join(candidates, "doc"))

    def finish(whole: pa.RecordBatch, own: list) -> Iterator[pa.RecordBatch]:
        at = 0
        for part, texts in slices(whole):
            out = list(_kept(texts, own[at : at + len(texts)], width))
            at += len(texts)
            kept = [hashlib.sha256(x[2]).hexdigest() for x in out] if digest else [x[2].decode() for x in out]
            yield pa.RecordBatch.from_arrays(
                [part.column("doc"), pa.array([x[0] for x in out], pa.int64()), pa.array([x[1] for x in out], pa.int64()), pa.array(kept, pa.string())],
                ["doc", "n_words", "n_removed", "kept"],
            )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            whole = pa.RecordBatch.from_arrays([batch.column("doc"), _opened(batch.column("body"))], ["doc", "text"])
            yield from finish(whole, batch.column("starts").to_pylist())

    def leave(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from finish(batch, [None] * len(batch))

    columns = "doc long, n_words long, n_removed long, kept string"
    shorter = found.select("doc", "starts", "body").mapInArrow(cut, columns)
    if digest:
        as_is = rows.mapInArrow(leave, columns).join(found.select("doc"), "doc", "left_anti")
    else:
        as_is = rows.join(found.select("doc"), "doc", "left_anti").mapInArrow(leave, columns)
    every = shorter.union(as_is).join(keyed.select("doc", "own"), "doc")
    return every.select(F.col("own").alias(id), "n_words", "n_removed", F.col("kept").alias("kept_sha256" if digest else "kept"))


def cut_repeated(documents: DataFrame, width: int = WIDTH, id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents without the words that repeated windows cover, as in ``remove_repeated``; other columns as they are.

    A text that loses words becomes the others joined by one space (empty if none is left); the rest stays unchanged, null
    texts too. No row is dropped.
    """
    key, places = free_name(documents, "row"), free_name(documents, "starts")
    keyed = row_keys(documents, id, key)
    starts, _ = repeated_windows(keyed.select(keyed[key].alias("doc"), keyed[text].cast("string").alias("text")), width)
    found = written(starts).select(F.col("doc").alias(key), F.col("starts").alias(places))

    @F.pandas_udf("string")
    def shorter(bodies: pd.Series, starts: pd.Series) -> pd.Series:
        out, at = [], 0
        batch = pa.RecordBatch.from_arrays([pa.array(bodies, pa.string(), from_pandas=True)], ["text"])
        lists = [None if x is None else x.tolist() for x in starts]
        for _, texts in slices(batch):
            out += [kept.decode() for _, _, kept in _kept(texts, lists[at : at + len(texts)], width)]
            at += len(texts)
        return pd.Series(out, dtype=object)

    cut = F.when(F.col(places).isNull(), F.col(text)).otherwise(shorter(text, places))
    return keyed.join(found, key, "left").withColumn(text, cut).select(*documents.columns)
