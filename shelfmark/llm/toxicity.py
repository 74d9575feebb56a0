"""Toxicity by the nearest labelled examples under TF-IDF cosine over all terms of the examples, found exactly.

Terms are runs of letters; every term that an example holds is known. Weights are (1 + log tf) * idf with document frequencies
over all documents, and vectors have length 1. The examples stand in blocks of similar ones. The index holds the
postings of each term and, for terms that many examples hold, the weights block by block with the largest one of each block. A text's
few postings of rare terms are added up first; with the maxima of its common terms they bound its cosines in a block. Blocks are read
in falling order of their bounds, until no bound reaches the worst of the nearest found. A neighbour's vote falls with its distance
in the terms that tell the classes apart: it counts the square of the cosine in which terms weigh more by chi-square, for how far
their presence among the examples depends on the label. Classes count at their rates among all labelled rows, and votes are mapped
to a probability by those that the examples themselves get from the other examples.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.letters import terms_of
from shelfmark.llm.tables import slices, texts_of
from shelfmark.llm.words import U, mix

# Bound of the model: examples a class.
EXAMPLES = 1500
# Nearest examples that vote, examples of a block, texts that are handled at once.
NEAREST = 50
BLOCK = 64
TEXTS = 128
# Terms that more than this part of the examples hold are read from a dense table, block by block; at most so many terms.
COMMON = 1 / 24
MOST_COMMON = 2048
# Dimensions in which examples are compared to form blocks, and rounds of forming them.
FOLDED = 256
ROUNDS = 5

_RUN = regex.compile(r"\p{L}+")


def examples_of(documents: DataFrame, labels: DataFrame, id: str, text: str, label: str) -> tuple[DataFrame, float]:
    """((id, label, text, h: hash of the text) of a bounded sample of different labelled texts, rate of label 1 among all labelled texts).

    Copies count once, with the label that most of them have. Within a class, texts are taken in the order of their hashes.
    """
    own = labels.select(F.col(id).alias("id"), F.col(label).cast("double").alias("label")).filter("label IS NOT NULL")
    own = own.groupBy("id").agg(F.avg("label").alias("label"))
    texts = documents.select(F.col(id).alias("id"), F.col(text).cast("string").alias("text"))
    marks = texts.select("id", F.xxhash64("text").alias("h")).join(own, "id").groupBy("h").agg(F.min("id").alias("id"), F.avg("label").alias("p"))
    marks = marks.select("h", "id", (F.col("p") >= 0.5).cast("int").alias("label"))
    rate = marks.agg(F.avg("label")).first()[0]
    # a limit after an order keeps the first rows in every task; a window of more than 1,000 rows would sort the whole class in one
    zeros, ones = (marks.filter(F.col("label") == k).orderBy("h", "id").limit(EXAMPLES) for k in (0, 1))
    chosen = zeros.union(ones).select("id", "label")
    hashed = texts.join(chosen, "id").select("id", "label", F.coalesce("text", F.lit("")).alias("text"))
    return hashed.withColumn("h", F.sha2(F.col("text").cast("binary"), 256)), rate or 0.0


def _terms_of_examples(examples: DataFrame) -> DataFrame:
    """(id, label, h, terms, tf): the different terms of each example and how often it holds them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, counts = [], []
            for body in texts_of(batch.column("text")).to_pylist():
                tf: dict[str, int] = {}
                for m in _RUN.finditer(body):
                    # letter by letter, as the batch form folds them: no letter becomes two
                    term = "".join(c.lower() if len(c.lower()) == 1 else c for c in m[0])
                    tf[term] = tf.get(term, 0) + 1
                names.append(list(tf))
                counts.append(list(tf.values()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("label").cast(pa.int32()), batch.column("h"), pa.array(names, pa.list_(pa.string())), pa.array(counts, pa.list_(pa.int32()))],
                ["id", "label", "h", "terms", "tf"],
            )

    kind = examples.schema["id"].dataType.simpleString()
    return examples.mapInArrow(run, f"id {kind}, label int, h string, terms array<string>, tf array<int>")


def _chi2(n11, n10, n01, n00):
    """Statistic of a two-by-two table: rows of label 1 with and without the term, of label 0 with and without it; 0 without two classes."""
    total = n11 + n10 + n01 + n00
    below = (n11 + n10) * (n01 + n00) * (n11 + n01) * (n10 + n00)
    return np.where(below > 0, total * (n11 * n00 - n10 * n01) ** 2 / np.maximum(below, 1), 0.0)


@dataclass
class Rows:
    """A sparse matrix by rows: where the entries of each row begin (one more), and the term and weight of each entry."""

    first: np.ndarray
    terms: np.ndarray
    weights: np.ndarray

    @staticmethod
    def of(n: int, row: np.ndarray, terms: np.ndarray, weights: np.ndarray) -> Rows:
        """From entries in the order of their rows."""
        return Rows(np.searchsorted(row, np.arange(n + 1)), terms, weights)

    @staticmethod
    def of_dense(matrix: np.ndarray) -> Rows:
        row, terms = np.nonzero(matrix)
        return Rows.of(len(matrix), row, terms, matrix[row, terms])

    def __len__(self) -> int:
        return len(self.first) - 1

    def numbers(self) -> np.ndarray:
        """The row of each entry."""
        return np.repeat(np.arange(len(self)), np.diff(self.first))

    def part(self, a: int, b: int) -> Rows:
        own = slice(self.first[a], self.first[b])
        return Rows(self.first[a : b + 1] - self.first[a], self.terms[own], self.weights[own])

    def dense(self, width: int) -> np.ndarray:
        out = np.zeros((len(self), width))
        out[self.numbers(), self.terms] = self.weights
        return out


@dataclass
class Vocabulary:
    """Terms in the order of their hashes, with their weights."""

    names: list[str]
    hashes: np.ndarray
    weight: np.ndarray
    # how much more a term weighs in votes than in the cosine
    factor: np.ndarray

    def rows(self, texts: pa.Array) -> Rows:
        """A row of length 1 for each text; a text without a known term has no entries."""
        at, text = _known(self.hashes, *terms_of(texts))
        width = max(1, len(self.names))
        pairs, counts = np.unique(text * width + at, return_counts=True)
        return self.weighted(len(texts), pairs // width, pairs % width, counts)

    def weighted(self, n: int, row: np.ndarray, terms: np.ndarray, counts: np.ndarray) -> Rows:
        weights = (1 + np.log(counts)) * self.weight[terms]
        norm = np.sqrt(np.bincount(row, weights**2, minlength=n))
        return Rows.of(n, row, terms, weights / norm[row])

    def vectors(self, texts: pa.Array) -> np.ndarray:
        """The rows as a dense matrix."""
        return self.rows(texts).dense(len(self.names))


def _known(hashes: np.ndarray, terms: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place among the sorted hashes, text) of the terms that are among them."""
    if not len(hashes) or not len(terms):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    at = np.minimum(np.searchsorted(hashes, terms), len(hashes) - 1)
    hit = hashes[at] == terms
    return at[hit], text[hit]


def _frequencies(rows: DataFrame, hashes: np.ndarray) -> tuple[np.ndarray, int]:
    """(number of documents that hold each term, number of documents), over all rows."""

    shared = rows.sparkSession.sparkContext.broadcast(hashes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = shared.value
        counts, n = np.zeros(len(hashes), np.int64), 0
        for batch in batches:
            n += len(batch)
            for _, texts in slices(batch):
                at, text = _known(hashes, *terms_of(texts))
                pairs = np.unique(text * len(hashes) + at)
                counts += np.bincount(pairs % len(hashes), minlength=len(hashes))
        held = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(held, -1), pa.int32()), pa.array(np.append(counts[held], n), pa.int64())], ["term", "n"])

    found = rows.select("text").mapInArrow(run, "term int, n long").groupBy("term").agg(F.sum("n").alias("n")).toArrow()
    terms, sums = found.column("term").to_numpy(), found.column("n").to_numpy()
    df = np.zeros(len(hashes), np.int64)
    df[terms[terms >= 0]] = sums[terms >= 0]
    return df, int(sums[terms < 0].sum())


def _clusters(rows: Rows, size: int) -> np.ndarray:
    """A cluster for each row, for about ``size`` rows each: rows with similar weights, folded into few dimensions."""
    n = len(rows)
    clusters = max(1, n // size)
    term = mix(rows.terms.astype(U), 31)
    sign = 1.0 - 2.0 * (term >> U(63)).astype(float)
    cell = rows.numbers() * FOLDED + (term % U(FOLDED)).astype(np.int64)
    points = np.bincount(cell, rows.weights * sign, minlength=n * FOLDED).reshape(n, FOLDED)
    centres = points[np.linspace(0, n - 1, clusters).astype(np.int64)] if n else points
    nearest = np.zeros(n, np.int64)
    for _ in range(ROUNDS if n else 0):
        nearest = (points @ centres.T).argmax(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, points)
        length = np.linalg.norm(sums, axis=1, keepdims=True)
        centres = np.where(length > 0, sums / np.maximum(length, 1e-12), centres)
    return nearest


class BlockIndex:
    """A block-max inverted index of the examples: postings by term, and of common terms also by block, with the largest weight there.

    Examples are numbered in their given order, which settles equal cosines. ``read`` and ``blocks`` count the blocks that
    queries read and those that they could have read.
    """

    def __init__(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray | Rows, vocabulary: Vocabulary, rate: float):
        self.vocabulary = vocabulary
        rows = vectors if isinstance(vectors, Rows) else Rows.of_dense(vectors)
        full = np.diff(rows.first) > 0
        order = np.flatnonzero(full)
        self.ids, self.labels = ids[order], labels[order]
        places = np.zeros(len(full), np.int64)
        places[order] = np.arange(len(order))
        place, width = places[rows.numbers()], len(vocabulary.names)
        # the examples block by block: where each stands, and which one stands at a position
        whole = Rows.of(len(order), place, rows.terms, rows.weights)
        self.standing = np.lexsort((np.arange(len(order)), _clusters(whole, BLOCK)))
        position = np.empty(len(order), np.int64)
        position[self.standing] = np.arange(len(order))
        self.many = max(1, -(-len(order) // BLOCK))
        at = position[place]
        by_term = np.lexsort((at, rows.terms))
        self.at, self.weight = at[by_term], rows.weights[by_term]
        self.first = np.searchsorted(rows.terms[by_term], np.arange(width + 1))
        # common terms: numbered, all others -1
        held = np.bincount(rows.terms, minlength=width)
        most = np.argsort(-held, kind="stable")[:MOST_COMMON]
        most = most[held[most] > len(order) * COMMON]
        self.common = np.full(width, -1)
        self.common[most] = np.arange(len(most))
        # terms and weights of each example as they count in votes
        self.telling = self.retold(whole)
        self._table: tuple | None = None
        self.read = self.blocks = 0
        # what an example counts: its class as often as among all labelled rows
        ones, zeros = max(1, int(labels.sum())), max(1, int((labels == 0).sum()))
        self.count = np.array([(1 - rate) / zeros, rate / ones]) * (ones + zeros)
        self.rate = rate
        # texts without a known term: the rate among such examples
        none = labels[~full]
        share = self.count[1] * none.sum() / max(1e-12, self.count[none].sum()) if len(none) else rate
        self.blank = float((share * len(none) + rate) / (len(none) + 1))
        self.curve = (np.array([0.0, 1.0]), np.array([0.0, 1.0]))
        self.calibrate(rows, order)

    def __getstate__(self) -> dict:
        return self.__dict__ | {"_table": None}

    def table(self) -> tuple[np.ndarray, np.ndarray]:
        """((blocks, common terms, BLOCK): the weights of common terms; (common terms, blocks): their maxima), made where they are used."""
        if self._table is None:
            out = np.zeros((self.many, int(self.common.max(initial=-1)) + 1, BLOCK))
            own = np.repeat(self.common, np.diff(self.first))
            of = own >= 0
            out[self.at[of] // BLOCK, own[of], self.at[of] % BLOCK] = self.weight[of]
            self._table = out, out.max(axis=2).T.copy()
        return self._table

    @property
    def weights(self) -> np.ndarray:
        """All weights as one dense matrix of terms and examples."""
        out = np.zeros((len(self.first) - 1, len(self.ids)))
        out[np.repeat(np.arange(len(out)), np.diff(self.first)), self.standing[self.at]] = self.weight
        return out

    def parted(self, queries: Rows) -> tuple[np.ndarray, np.ndarray]:
        """(rows, blocks, BLOCK): what rare terms add to the cosines; (rows, common terms): the weights of common ones."""
        row, number = queries.numbers(), self.common[queries.terms]
        of = number >= 0
        dense = np.zeros((len(queries), int(self.common.max(initial=-1)) + 1))
        dense[row[of], number[of]] = queries.weights[of]
        row, terms, weights = row[~of], queries.terms[~of], queries.weights[~of]
        length = self.first[terms + 1] - self.first[terms]
        posting = np.arange(int(length.sum())) + np.repeat(self.first[terms] - np.cumsum(length) + length, length)
        cell = np.repeat(row * self.many * BLOCK, length) + self.at[posting]
        sums = np.bincount(cell, np.repeat(weights, length) * self.weight[posting], minlength=len(queries) * self.many * BLOCK)
        return sums.astype(float, copy=False).reshape(len(queries), self.many, BLOCK), dense

    def in_block(self, rare: np.ndarray, common: np.ndarray, row: np.ndarray, block: np.ndarray) -> np.ndarray:
        """(pairs, BLOCK): cosines of each given row with the examples of its block, from both parts of the rows."""
        sums = rare[row, block]
        order = np.argsort(block, kind="stable")
        some, first = np.unique(block[order], return_index=True)
        for number, own in zip(some, np.split(order, first[1:])):
            sums[own] += common[row[own]] @ self.table()[0][number]
        return sums

    def nearest(self, queries: np.ndarray | Rows, k: int, skip: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(cosines, places) of the k nearest examples of each row, best first, equal ones in the order of the examples.

        Examples without a common term (cosine 0) are none.
        """
        queries = queries if isinstance(queries, Rows) else Rows.of_dense(queries)
        n, examples = len(queries), len(self.ids)
        best, place = np.zeros((n, k)), np.full((n, k), -1)
        if not examples:
            return best, place
        standing = np.append(self.standing, np.full(self.many * BLOCK - examples, examples)).reshape(self.many, BLOCK)
        for a in range(0, n, TEXTS):
            b = min(a + TEXTS, n)
            own = queries.part(a, b)
            rare, common = self.parted(own)
            bounds = rare.max(axis=2) + common @ self.table()[1]
            falling = np.argsort(-bounds, axis=1, kind="stable")
            scores, places = best[a:b], place[a:b]
            self.blocks += (b - a) * self.many
            row = np.arange(b - a)
            for turn in range(self.many):
                block = falling[row, turn]
                reach = bounds[row, block]
                # an equal cosine may still win by its place; sums differ in their last digits
                go = (reach > 0) & (reach >= scores[row, -1] - 1e-9)
                row, block = row[go], block[go]
                if not len(row):
                    break
                self.read += len(row)
                found = np.round(self.in_block(rare, common, row, block), 12)
                at = standing[block]
                if skip is not None:
                    found[at == skip[a:b][row][:, None]] = 0
                values, names = np.concatenate([scores[row], found], axis=1), np.concatenate([places[row], at], axis=1)
                names = np.where(values > 0, names, examples)
                order = np.lexsort((names, -values), axis=1)[:, :k]
                scores[row] = np.take_along_axis(values, order, axis=1)
                names = np.take_along_axis(names, order, axis=1)
                places[row] = np.where(names < examples, names, -1)
        return best, place

    def retold(self, rows: Rows) -> Rows:
        """The rows with each term's factor, at length 1 again."""
        weights = rows.weights * self.vocabulary.factor[rows.terms]
        norm = np.sqrt(np.bincount(rows.numbers(), weights**2, minlength=len(rows)))
        return Rows(rows.first, rows.terms, weights / norm[rows.numbers()])

    def votes(self, queries: Rows, place: np.ndarray) -> np.ndarray:
        """Share of label 1 among the nearest, each at its closeness times its class's count, with one vote at the rate."""
        asked, those = self.retold(queries), self.telling
        close = np.zeros(place.shape)
        row = np.zeros(len(self.vocabulary.names))
        for k, own in enumerate(place):
            mine = slice(asked.first[k], asked.first[k + 1])
            row[asked.terms[mine]] = asked.weights[mine]
            near = own[own >= 0]
            size = those.first[near + 1] - those.first[near]
            entry = np.arange(int(size.sum())) + np.repeat(those.first[near] - np.cumsum(size) + size, size)
            if len(entry):
                close[k, own >= 0] = np.add.reduceat(row[those.terms[entry]] * those.weights[entry], np.cumsum(size) - size)
            row[asked.terms[mine]] = 0
        label = np.where(place >= 0, self.labels[place], 0) if len(self.labels) else np.zeros_like(place)
        weight = np.where(place >= 0, close**2 * self.count[label], 0)
        return ((weight * label).sum(axis=1) + self.rate * 0.5) / (weight.sum(axis=1) + 0.5)

    def calibrate(self, rows: Rows, order: np.ndarray) -> None:
        """Votes of each example among the others, made a rising step function to the rate of label 1 (pool adjacent)."""
        if not len(self.labels):
            return
        skip = np.full(len(rows), 0)
        skip[order] = np.arange(len(order))
        best, place = self.nearest(rows, NEAREST, skip=skip)
        votes = self.votes(rows, place)[order]
        pools: list[list[float]] = []
        for v in np.argsort(votes, kind="stable"):
            weight = self.count[self.labels[v]]
            pools.append([votes[v] * weight, weight, weight * self.labels[v]])
            while len(pools) > 1 and pools[-2][2] / pools[-2][1] >= pools[-1][2] / pools[-1][1]:
                top = pools.pop()
                pools[-1] = [x + y for x, y in zip(pools[-1], top)]
        x, y = np.array([p[0] / p[1] for p in pools]), np.array([p[2] / p[1] for p in pools])
        self.curve = np.concatenate([[0.0], x, [1.0]]), np.concatenate([[y[0]], y, [y[-1]]])

    def score(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, Rows]:
        """(probabilities, cosines, places, weighted terms) of texts."""
        rows = self.vocabulary.rows(texts)
        best, place = self.nearest(rows, NEAREST)
        probability = np.interp(self.votes(rows, place), *self.curve)
        return np.clip(np.where(place[:, 0] >= 0, probability, self.blank), 0.001, 0.999), best, place, rows


def fit(documents: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", label: str = "toxic") -> BlockIndex:
    """The index of a bounded sample of labelled documents; document frequencies are counted over all of ``documents``."""
    examples, rate = examples_of(documents, labels, id, text, label)
    found = _terms_of_examples(examples).toArrow().combine_chunks().sort_by([("h", "ascending"), ("id", "ascending")])
    ids, marks = found.column("id").to_numpy().astype(np.int64), found.column("label").to_numpy().astype(np.int64)
    lists = found.column("terms").combine_chunks() if found.num_rows else pa.array([], pa.list_(pa.string()))
    counts = found.column("tf").combine_chunks().flatten().to_numpy() if found.num_rows else np.zeros(0, np.int64)
    row = np.repeat(np.arange(len(ids)), np.diff(lists.offsets.to_numpy()))
    coded = lists.flatten().dictionary_encode()
    # a name that the batch form reads as no term cannot meet a text
    hashes, first = np.zeros(len(coded.dictionary), U), np.zeros(len(coded.dictionary), bool)
    own, name = terms_of(coded.dictionary)
    hashes[name[::-1]], first[name] = own[::-1], True
    order = np.flatnonzero(first)
    order = order[np.argsort(hashes[order])]
    number = np.full(len(first), -1)
    number[order] = np.arange(len(order))
    terms = number[coded.indices.to_numpy()]
    row, terms, counts = row[terms >= 0], terms[terms >= 0], counts[terms >= 0]
    df, n = _frequencies(documents.select(F.col(text).cast("string").alias("text")), hashes[order]) if len(order) else (np.zeros(0), 0)
    ones, zeros = float(marks.sum()), float((marks == 0).sum())
    n1 = np.bincount(terms, marks[row], minlength=len(order))
    n0 = np.bincount(terms, minlength=len(order)) - n1
    factor = 1 + np.sqrt(_chi2(n1, ones - n1, n0, zeros - n0))
    vocabulary = Vocabulary(coded.dictionary.take(pa.array(order)).to_pylist(), hashes[order], np.log((1 + n) / (1 + df)) + 1, factor)
    return BlockIndex(ids, marks, vocabulary.weighted(len(ids), row, terms, counts), vocabulary, rate)


def score_toxicity(documents: DataFrame, labels: DataFrame, corpus: DataFrame | None = None, id: str = "doc_id", text: str = "text", label: str = "toxic") -> DataFrame:
    """(id, score, predicted, neighbours, evidence) for every document; the model is learned from ``labels``.

    ``corpus`` holds the texts of the labelled rows (``documents`` if not given). ``score`` is the calibrated probability of label
    1, ``predicted`` whether it is at least 0.5, ``neighbours`` the voting examples with cosine and label, nearest first (equal
    cosines in the order of the hashes of the examples' texts), and
    ``evidence`` the text's known terms by falling weight in votes. Null and empty texts, and texts that share no term with an example,
    have no neighbours and get the rate of such examples. Without labels of both classes every score is the rate. Repeated rows
    are scored one by one; an empty table gives no rows. The model has a bounded number of examples and is broadcast; no shuffle
    of texts.
    """
    index = fit(documents if corpus is None else corpus, labels, id, text, label)
    shared = documents.sparkSession.sparkContext.broadcast(index)
    rows = documents.select(documents[id].alias("id"), documents[text].cast("string").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared.value
        names = pa.array(index.vocabulary.names, pa.string())
        for batch in batches:
            for part, texts in slices(batch):
                scores, best, place, terms = index.score(texts)
                there = place >= 0
                own = place[there]
                votes = pa.StructArray.from_arrays(
                    [pa.array(index.ids[own], pa.int64()), pa.array(best[there], pa.float64()), pa.array(index.labels[own], pa.int32())], ["id", "cosine", "label"]
                )
                near = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(there.sum(axis=1))), pa.int32()), votes)
                falling = np.lexsort((terms.terms, -terms.weights * index.vocabulary.factor[terms.terms], terms.numbers()))
                known = pa.ListArray.from_arrays(pa.array(terms.first, pa.int32()), names.take(pa.array(terms.terms[falling])))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("id"),
                        pa.array(scores),
                        pa.array((scores >= 0.5).astype(np.int32)),
                        near,
                        known,
                    ],
                    ["id", "score", "predicted", "neighbours", "evidence"],
                )

    columns = "score double, predicted int, neighbours array<struct<id:long,cosine:double,label:int>>, evidence array<string>"
    return rows.mapInArrow(run, f"id {kind}, {columns}").withColumnRenamed("id", id)


def reject_toxic(documents: DataFrame, labels: DataFrame, threshold: float = 0.5, id: str = "doc_id", text: str = "text", label: str = "toxic") -> DataFrame:
    """The documents whose score is below the threshold; all columns as they are, null and empty texts scored as empty."""
    shared = documents.sparkSession.sparkContext.broadcast(fit(documents, labels, id, text, label))

    @F.pandas_udf("double")
    def score(bodies: pd.Series) -> pd.Series:
        batch = pa.RecordBatch.from_arrays([pa.array(bodies, pa.string(), from_pandas=True)], ["text"])
        parts = [shared.value.score(texts)[0] for _, texts in slices(batch)]
        return pd.Series(np.concatenate(parts) if parts else np.zeros(0))

    return documents.filter(score(documents[text].cast("string")) < threshold)
