"""Benchmark passages in training texts, found with a distributed positional inverted index.

The index is cut by documents, as search engines cut it: a segment holds the term dictionary and the positional postings of
some documents and is one row of a written table. So a term that every document holds has no list larger than a segment,
postings never travel, and one index answers many test sets. A window of test words is found by taking the postings of its
rarest term in the segment, moved back by the term's place in the window, and intersecting them with the other terms' lists in
order of length. Lists may also agree up to a distance, which gives proximity matches.

Words are runs of digits, ASCII letters (A-Z folded) and characters from U+0080 on, compared by 64 bits of a hash.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.tables import prepare, raw, slices, written
from shelfmark.llm.words import U, split_words

WIDTH = 10
# Words and documents of a segment, words of the test items that are searched at once, and candidate places handled at once.
SEGMENT = 300_000
GROUP_WORDS = 500_000
CANDIDATES = 1_000_000

_FOLDED = np.full(256, 0x20, np.uint8)
_FOLDED[0x80:] = np.arange(0x80, 256)
_FOLDED[ord("0") : ord("9") + 1] = np.arange(ord("0"), ord("9") + 1)
_FOLDED[ord("a") : ord("z") + 1] = _FOLDED[ord("A") : ord("Z") + 1] = np.arange(ord("a"), ord("z") + 1)


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of all words, number of words of each text)."""
    data, offsets = raw(texts)
    plain = pa.StringArray.from_buffers(len(texts), pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(_FOLDED[data]))
    words = split_words(plain)
    return words.hashes, words.counts()


def _packed(values: np.ndarray, press: zstandard.ZstdCompressor) -> bytes:
    """Differences of neighbours, the same byte of all of them together."""
    steps = np.diff(values.astype("<u4"), prepend=np.uint32(0))
    return press.compress(steps.view(np.uint8).reshape(-1, 4).T.tobytes())


def _opened(data: bytes, n: int) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    return np.cumsum(np.ascontiguousarray(planes.reshape(4, n).T).view("<u4").ravel(), dtype=np.uint32).astype(np.int64)


@dataclass
class Segment:
    """Terms in rising order with their numbers of places, all places term by term, and the words of each document.

    Word k of document d has the place ``first[d] + k``; one place is left free behind each document, so that no run of
    places crosses documents.
    """

    terms: np.ndarray
    counts: np.ndarray
    places: np.ndarray
    lengths: np.ndarray
    first: np.ndarray = field(init=False)
    begins: np.ndarray = field(init=False)
    keys: np.ndarray = field(init=False)

    def __post_init__(self):
        self.first = np.cumsum(self.lengths + 1) - self.lengths - 1
        self.begins = np.cumsum(self.counts) - self.counts
        # postings in one rising order: (term, place)
        self.keys = (np.repeat(np.arange(len(self.terms)), self.counts) << 32) | self.places

    @classmethod
    def of(cls, hashes: np.ndarray, lengths: np.ndarray) -> Segment:
        place = np.arange(len(hashes)) + np.repeat(np.arange(len(lengths)), lengths)
        order = np.argsort(hashes, kind="stable")
        terms, counts = np.unique(hashes, return_counts=True)
        return cls(terms, counts, place[order], lengths)


def build_index(documents: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """The positional inverted index of all documents as a written table, one row per segment (an action).

    Columns: ids, lengths (words) of the segment's documents, terms, counts, places. Null texts have no words; every row is a
    document of its own, also where ids are null or repeated. A text longer than a segment is a segment of its own. An
    empty table gives an empty index. A task packs the rows of its input split, so there is no shuffle.
    """
    prepare(documents.sparkSession)
    rows = documents.select(documents[id].alias("id"), documents[text].cast("string").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=1)
        ids, hashes, lengths, size = [], [], [], 0

        def close() -> pa.RecordBatch:
            all_lengths = np.concatenate(lengths)
            x = Segment.of(np.concatenate(hashes), all_lengths)
            own = pa.ListArray.from_arrays(pa.array([0, len(all_lengths)], pa.int32()), pa.concat_arrays(ids))
            sizes = pa.array([all_lengths.tolist()], pa.list_(pa.int32()))
            blocks = [pa.array([y], pa.binary()) for y in (x.terms.tobytes(), _packed(x.counts, press), _packed(x.places, press))]
            return pa.RecordBatch.from_arrays([own, sizes, *blocks], ["ids", "lengths", "terms", "counts", "places"])

        for batch in batches:
            for part, texts in slices(batch):
                found, counts = word_hashes(texts)
                ids.append(part.column("id"))
                hashes.append(found)
                lengths.append(counts)
                size += len(found) + len(counts)
                if size >= SEGMENT:
                    yield close()
                    ids, hashes, lengths, size = [], [], [], 0
        if size:
            yield close()

    return written(rows.mapInArrow(run, f"ids array<{kind}>, lengths array<int>, terms binary, counts binary, places binary"))


def _segment(batch: pa.RecordBatch, k: int) -> Segment:
    terms, counts, places, lengths = (batch.column(name)[k].as_py() for name in ("terms", "counts", "places", "lengths"))
    terms = np.frombuffer(terms, U)
    counts = _opened(counts, len(terms))
    return Segment(terms, counts, _opened(places, int(counts.sum())), np.array(lengths, np.int64))


@dataclass
class Windows:
    """Different windows of one length: their terms as numbers of the vocabulary, and (window, item, place in the item)."""

    terms: np.ndarray
    window: np.ndarray
    item: np.ndarray
    place: np.ndarray


class Items:
    """Some test items: their words as hashes, item by item."""

    def __init__(self, names: list[str], words: list[np.ndarray], width: int):
        self.names, self.width, self.words = names, width, words
        self.vocabulary: np.ndarray | None = None

    def windows(self) -> list[Windows]:
        """Windows by length: ``width`` words, or the whole of a shorter item."""
        if self.vocabulary is not None:
            return self._windows
        lengths = np.array([len(x) for x in self.words], np.int64)
        self.vocabulary, terms = np.unique(np.concatenate(self.words), return_inverse=True)
        first = np.cumsum(lengths) - lengths
        of = np.minimum(lengths, self.width)
        self._windows = []
        for length in np.unique(of).tolist():
            items = np.flatnonzero(of == length)
            many = lengths[items] - length + 1
            item = np.repeat(items, many)
            place = np.arange(len(item)) - np.repeat(np.cumsum(many) - many, many)
            rows = terms[(first[item] + place)[:, None] + np.arange(length)]
            unique, window = np.unique(rows, axis=0, return_inverse=True)
            self._windows.append(Windows(unique, window.ravel(), item, place))
        return self._windows


def _spread(begins: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, begins[row] + 0, 1, ... counts[row] - 1) for every row."""
    row = np.repeat(np.arange(len(counts)), counts)
    return row, np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts) + begins[row]


def occurrences(segment: Segment, vocabulary: np.ndarray, windows: Windows, slop: int = 0) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(window, document, start) where every term k of the window occurs at most ``slop`` words from start + k.

    Starts count from the document's first word; with a slop they may lie up to it before or behind the text.
    """
    if not len(segment.terms):
        return
    at = np.minimum(np.searchsorted(segment.terms, vocabulary), len(segment.terms) - 1)
    counts = np.where(segment.terms[at] == vocabulary, segment.counts[at], 0)
    alive = np.flatnonzero((counts[windows.terms] > 0).all(axis=1))
    shifts = np.arange(-slop, slop + 1)
    listed = counts[windows.terms[alive]]
    order = np.argsort(listed, axis=1, kind="stable")
    done = np.cumsum(listed.min(axis=1, initial=1 << 60) * len(shifts)) if len(alive) else np.zeros(0, np.int64)
    cut = 0
    while cut < len(alive):
        end = max(cut + 1, int(np.searchsorted(done, (done[cut - 1] if cut else 0) + CANDIDATES, side="right")))
        terms, rank = windows.terms[alive[cut:end]], order[cut:end]
        rows = np.arange(len(terms))
        rarest = at[terms[rows, rank[:, 0]]]
        row, index = _spread(segment.begins[rarest], segment.counts[rarest])
        place = segment.places[index]
        doc = np.searchsorted(segment.first, place, side="right") - 1
        start = place - rank[row, 0]
        if slop:
            row, doc, start = (np.repeat(x, len(shifts)) for x in (row, doc, start))
            start = start + np.tile(shifts, len(start) // len(shifts))
            row, doc, start = np.unique(np.stack([row, doc, start]), axis=1)
        else:
            inside = (start >= segment.first[doc]) & (start + terms.shape[1] <= segment.first[doc] + segment.lengths[doc])
            row, doc, start = row[inside], doc[inside], start[inside]
        for k in range(1, terms.shape[1]):
            if not len(row):
                break
            column = rank[row, k]
            term = at[terms[row, column]] << 32
            low = np.maximum(start + column - slop, segment.first[doc])
            high = np.minimum(start + column + slop, segment.first[doc] + segment.lengths[doc] - 1)
            nearest = segment.keys[np.minimum(np.searchsorted(segment.keys, term | low), len(segment.keys) - 1)]
            met = (low <= high) & (nearest >= (term | low)) & (nearest <= (term | np.maximum(high, 0)))
            row, doc, start = row[met], doc[met], start[met]
        if len(row):
            yield alive[cut + row], doc, start - segment.first[doc]
        cut = end


def _merged(spans: np.ndarray) -> np.ndarray:
    """(document, begin, end) rows without overlaps."""
    if not len(spans):
        return spans
    spans = spans[np.lexsort((spans[:, 1], spans[:, 0]))]
    # documents are told apart by a shift that no span reaches across
    shift = spans[:, 0] * (spans[:, 2].max() + 2)
    reach = np.maximum.accumulate(spans[:, 2] + shift)
    new = np.ones(len(spans), bool)
    new[1:] = spans[1:, 1] + shift[1:] > reach[:-1]
    begin = np.flatnonzero(new)
    return np.stack([spans[begin, 0], spans[begin, 1], np.maximum.reduceat(reach, begin) - shift[begin]], axis=1)


def _groups(benchmark: DataFrame, width: int, item: str, text: str) -> Iterator[Items]:
    """The test items in groups of bounded size; items without words are left out."""
    rows = benchmark.select(F.coalesce(benchmark[item].cast("string"), F.lit("")).alias("name"), benchmark[text].cast("string").alias("text"))

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in slices(batch):
                hashes, counts = word_hashes(texts)
                own = [x.tobytes() for x in np.split(hashes, np.cumsum(counts)[:-1])]
                yield pa.RecordBatch.from_arrays([part.column("name"), pa.array(own, pa.binary())], ["name", "words"])

    names, words, size = [], [], 0
    for row in rows.mapInArrow(split, "name string, words binary").filter("length(words) > 0").toLocalIterator():
        names.append(row["name"])
        words.append(np.frombuffer(row["words"], U))
        size += len(words[-1])
        if size >= GROUP_WORDS:
            yield Items(names, words, width)
            names, words, size = [], [], 0
    if names:
        yield Items(names, words, width)


def find_phrases(index: DataFrame, benchmark: DataFrame, width: int = WIDTH, slop: int = 0, item: str = "item_id", text: str = "text") -> DataFrame:
    """(id, item, window, begin, end, exact): where windows of test items occur in the indexed documents.

    A window is ``width`` consecutive words of an item, or a shorter item as a whole; ``window`` is its place in the item.
    With ``slop`` 0 every exact occurrence is a row. With a larger one a proximity match is a place from which every
    word of the window lies at most ``slop`` words; neighbouring places make one row, and ``exact`` tells whether the phrase
    itself occurs there. ``begin`` and ``end`` (exclusive) are the words within reach. Item ids are texts here, null is the empty
    text. The test items are sent to the tasks in groups of bounded size, each group searches every segment.
    """
    kind = index.schema["ids"].dataType.elementType
    spark = index.sparkSession
    columns = [("item", pa.string()), ("window", pa.int64()), ("begin", pa.int64()), ("end", pa.int64()), ("exact", pa.bool_())]
    schema = f"id {kind.simpleString()}, item string, window long, begin long, end long, exact boolean"
    found = spark.createDataFrame([], schema)
    for group in _groups(benchmark, width, item, text):
        shared = spark.sparkContext.broadcast(group)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            items = shared.value
            for batch in batches:
                for k in range(len(batch)):
                    segment = _segment(batch, k)
                    ids = batch.column("ids")[k].values
                    for windows in items.windows():
                        length = windows.terms.shape[1]
                        exact = {x for w, d, s in occurrences(segment, items.vocabulary, windows) for x in zip(w.tolist(), d.tolist(), s.tolist())} if slop else None
                        for window, doc, start in occurrences(segment, items.vocabulary, windows, slop):
                            order = np.lexsort((start, doc, window))
                            window, doc, start = window[order], doc[order], start[order]
                            new = np.ones(len(start), bool)
                            new[1:] = (window[1:] != window[:-1]) | (doc[1:] != doc[:-1]) | (start[1:] != start[:-1] + 1) if slop else True
                            head = np.flatnonzero(new)
                            tail = np.append(head[1:], len(new)) - 1
                            begin = np.maximum(start[head] - slop, 0)
                            end = np.minimum(start[tail] + length + slop, segment.lengths[doc[head]])
                            if slop:
                                hit = np.array([x in exact for x in zip(window.tolist(), doc.tolist(), start.tolist())])
                                hit = np.logical_or.reduceat(hit, head)
                            else:
                                hit = np.ones(len(head), bool)
                            # one row for each item that has the window
                            by = np.argsort(windows.window, kind="stable")
                            first = np.searchsorted(windows.window[by], window[head])
                            many = np.searchsorted(windows.window[by], window[head], side="right") - first
                            row, owner = _spread(first, many)
                            owner = by[owner]
                            values = [[items.names[x] for x in windows.item[owner]], windows.place[owner], begin[row], end[row], hit[row]]
                            arrays = [ids.take(pa.array(doc[head][row])), *(pa.array(v, t) for v, (_, t) in zip(values, columns))]
                            yield pa.RecordBatch.from_arrays(arrays, ["id", *(name for name, _ in columns)])

        found = found.union(index.mapInArrow(run, schema))
    return found


def find_contamination(documents: DataFrame, benchmark: DataFrame, width: int = WIDTH, id: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text") -> DataFrame:
    """One row per document: (id, n_words, n_hit, items, spans).

    A window is ``width`` consecutive words of a test item, or a shorter item as a whole (an item without words has none). A
    word is hit if it lies in an occurrence of a window. ``items`` are the ids, as texts in rising order, of the items with a
    window in the document; a null id is the empty text. ``spans`` are the hit words as (begin, end exclusive), in order and
    without overlaps. Null and empty texts have no words; every row is a document of its own, whatever its id; other
    columns are ignored. Without test items nothing is hit; an empty table gives no rows.

    The index is written once; the items go through it in groups of bounded size, each of which adds its hits to the
    segments' rows. Nothing is shuffled.
    """
    index = build_index(documents, id, text)
    kind = index.schema["ids"].dataType.elementType.simpleString()
    carried = f"ids array<{kind}>, lengths array<int>, terms binary, counts binary, places binary, hits binary, owners array<int>, names array<string>"
    found = index.withColumns({"hits": F.lit(b""), "owners": F.array().cast("array<int>"), "names": F.array().cast("array<string>")})
    groups = [documents.sparkSession.sparkContext.broadcast(x) for x in _groups(benchmark, width, item, item_text)]

    def search(batch: pa.RecordBatch, k: int, items: Items | None) -> tuple[np.ndarray, set[tuple[int, str]]]:
        """What one segment holds so far and of one more group: ((document, begin, end), (document, item))."""
        spans = [np.frombuffer(batch.column("hits")[k].as_py(), np.int64).reshape(-1, 3)]
        pairs = set(zip(batch.column("owners")[k].as_py(), batch.column("names")[k].as_py()))
        segment = _segment(batch, k)
        for windows in items.windows() if items else ():
            by = np.argsort(windows.window, kind="stable")
            for window, doc, start in occurrences(segment, items.vocabulary, windows):
                spans.append(np.stack([doc, start, start + windows.terms.shape[1]], axis=1))
                window, doc = np.unique(np.stack([window, doc]), axis=1)
                first = np.searchsorted(windows.window[by], window)
                many = np.searchsorted(windows.window[by], window, side="right") - first
                pair, owner = _spread(first, many)
                met = np.unique(np.stack([doc[pair], windows.item[by[owner]]]), axis=1)
                pairs.update((d, items.names[x]) for d, x in met.T.tolist())
        return _merged(np.concatenate(spans)), pairs

    for shared in groups[:-1]:

        def carry(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for k in range(len(batch)):
                    spans, pairs = search(batch, k, shared.value)
                    new = [
                        pa.array([spans.tobytes()], pa.binary()),
                        pa.array([[d for d, _ in pairs]], pa.list_(pa.int32())),
                        pa.array([[name for _, name in pairs]], pa.list_(pa.string())),
                    ]
                    yield pa.RecordBatch.from_arrays([*batch.slice(k, 1).columns[:-3], *new], batch.schema.names)

        found = found.mapInArrow(carry, carried)

    last = groups[-1] if groups else None
    span = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(len(batch)):
                spans, pairs = search(batch, k, last.value if last else None)
                words = batch.column("lengths")[k].as_py()
                hits, names = [[] for _ in words], [[] for _ in words]
                for doc, begin, end in spans.tolist():
                    hits[doc].append({"begin": begin, "end": end})
                for doc, name in pairs:
                    names[doc].append(name)
                hit = [sum(x["end"] - x["begin"] for x in own) for own in hits]
                arrays = [pa.array(words, pa.int64()), pa.array(hit, pa.int64()), pa.array([sorted(x) for x in names], pa.list_(pa.string())), pa.array(hits, span)]
                yield pa.RecordBatch.from_arrays([batch.column("ids")[k].values, *arrays], ["id", "n_words", "n_hit", "items", "spans"])

    out = found.mapInArrow(finish, f"id {kind}, n_words long, n_hit long, items array<string>, spans array<struct<begin:long,end:long>>")
    return out.withColumnRenamed("id", id)
