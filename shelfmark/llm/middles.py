"""Fill-in-middle forms of texts, with cuts found in a Fenwick tree over blocks.

A text is cut into blocks of a fixed number of bytes. The tree holds, for each block, how many units end in it and how many
code points begin in it. The block in which a given unit ends is found by binary lifting: from the largest power of two down,
a step is taken while the units before it are too few. Only that block is then looked through for the boundary. The code
points of the sections are sums that the descent passes.

A unit is a word with the white space before it; white space at the end of a text is a unit of its own (white space: space
and U+0009 to U+000D).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from shelfmark.llm.tables import free_name, prepare, raw, slices

BLOCK = 512
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 9, 10, 11, 12, 13]] = True


class Fenwick:
    """Sums over the blocks of one text: units that end and code points that begin."""

    def __init__(self, counts: np.ndarray):
        """``counts``: (blocks, 2)."""
        self.size = len(counts)
        self.tree = np.zeros((self.size + 1, 2), np.int64)
        self.tree[1:] = counts
        step = 1
        while step < self.size:
            # nodes that cover ``step`` blocks give them to the next larger node
            low = np.arange(step, self.size + 1 - step, 2 * step)
            self.tree[low + step] += self.tree[low]
            step *= 2
        self.top = step if step <= self.size else step // 2

    def descend(self, unit: int) -> tuple[int, int, int]:
        """(block in which the unit of this number, from 1, ends; its number among the ends there; code points before the block)."""
        block, points, step = 0, 0, self.top
        while step:
            if block + step <= self.size:
                units, more = self.tree[block + step]
                if units < unit:
                    block += step
                    unit -= int(units)
                    points += int(more)
            step //= 2
        return block, unit, points


class Texts:
    """Units and blocks of the texts of a batch."""

    def __init__(self, texts: pa.Array):
        self.data, self.offsets = raw(texts)
        n = len(self.data)
        inside = ~_SPACE[self.data]
        last = np.zeros(n + 1, bool)  # a text begins behind
        last[self.offsets[1:]] = True
        self.ends = np.zeros(n, bool)  # a unit ends with this byte
        self.ends[:-1] = inside[:-1] & ~inside[1:]
        self.ends |= last[1:]
        self.begins = (self.data & 0xC0) != 0x80  # a character begins with this byte
        lengths = np.diff(self.offsets)
        blocks = -(-lengths // BLOCK)
        self.first = np.concatenate([[0], np.cumsum(blocks)])
        place = np.arange(self.first[-1]) - np.repeat(self.first[:-1], blocks)
        self.block_at = np.repeat(self.offsets[:-1], blocks) + place * BLOCK
        if n:
            self.counts = np.stack([np.add.reduceat(x, self.block_at, dtype=np.int64) for x in (self.ends, self.begins)], axis=1)
        else:
            self.counts = np.zeros((0, 2), np.int64)

    def tree(self, k: int) -> Fenwick:
        return Fenwick(self.counts[self.first[k] : self.first[k + 1]])

    def units(self, k: int) -> int:
        return int(self.counts[self.first[k] : self.first[k + 1], 0].sum())

    def cut(self, k: int, tree: Fenwick, unit: int) -> tuple[int, int]:
        """(byte, code point) of the text behind its first ``unit`` units."""
        if unit == 0:
            return 0, 0
        block, number, points = tree.descend(unit)
        at = int(self.block_at[self.first[k] + block])
        end = at + int(np.flatnonzero(self.ends[at : min(at + BLOCK, int(self.offsets[k + 1]))])[number - 1]) + 1
        return end - int(self.offsets[k]), points + int(self.begins[at:end].sum())


def draws(id: object, seed: int) -> list[int]:
    """Four numbers below 2**32 that depend on the id alone: SHA-256 of ``seed:id``; a null id counts as the empty text."""
    digest = hashlib.sha256(f"{seed}:{'' if id is None else id}".encode()).digest()
    return [int.from_bytes(digest[k : k + 4], "big") for k in (0, 4, 8, 12)]


def transform(texts: pa.Array, ids: list, seed: int, rate: int, spm_rate: int) -> Iterator[tuple[int, str, int | None, int | None, bytes]]:
    """(units, form, code points of the prefix, of the middle, output) of each text."""
    whole = Texts(texts)
    data = whole.data.tobytes()
    p, s, m = (x.encode() for x in (PREFIX, SUFFIX, MIDDLE))
    for k, id in enumerate(ids):
        body = data[whole.offsets[k] : whole.offsets[k + 1]]
        n = whole.units(k)
        h1, h2, h3, h4 = draws(id, seed)
        if not body or h3 % 100 >= rate or p in body or s in body or m in body:
            yield n, "plain", None, None, body
            continue
        tree = whole.tree(k)
        cuts = sorted((h1 % (n + 1), h2 % (n + 1)))
        (a, points), (b, until) = (whole.cut(k, tree, unit) for unit in cuts)
        head, middle, tail = body[:a], body[a:b], body[b:]
        if h4 % 100 < spm_rate:
            yield n, "spm", points, until - points, s + tail + p + head + m + middle
        else:
            yield n, "psm", points, until - points, p + head + s + tail + m + middle


def fill_in_middle(documents: DataFrame, seed: int = 42, rate: int = 50, spm_rate: int = 80, id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents with four columns more: ``n`` (units), ``form``, ``prefix_chars``, ``middle_chars``, and their text transformed.

    ``rate`` percent of the texts, drawn by ``seed`` and id, are cut in three at two drawn units, and ``spm_rate`` percent of these
    are written suffix first (form ``spm``): ``<S>`` suffix ``<P>`` prefix ``<M>`` middle. The others have the form ``psm``: ``<P>``
    prefix ``<S>`` suffix ``<M>`` middle. Empty texts and texts that hold one of the marks stay as they are (form ``plain``, lengths
    null). Null texts are empty. Lengths are code points. Rows with the same id are cut at the same draws, each in its own text;
    a null id is drawn as the empty text. New columns whose names are taken get an underscore. Rows are handled one by one
    in their input split; an empty table gives no rows.
    """
    prepare(documents.sparkSession)
    names = {name: free_name(documents, name) for name in ("n", "form", "prefix_chars", "middle_chars")}
    rows = documents.withColumn(text, documents[text].cast("string"))
    # the batch in the order of the columns, texts replaced, new columns at the end
    types = [pa.int64(), pa.string(), pa.int64(), pa.int64()]
    columns = rows.columns
    place, own = columns.index(text), columns.index(id)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in slices(batch, text):
                out = list(zip(*transform(texts, part.column(own).to_pylist(), seed, rate, spm_rate)))
                values = part.columns
                values[place] = pa.array(out[4], pa.binary()).cast(pa.string())
                yield pa.RecordBatch.from_arrays([*values, *(pa.array(x, t) for x, t in zip(out, types))], added)

    added = [*columns, *names.values()]
    kinds = (LongType(), StringType(), LongType(), LongType())
    return rows.mapInArrow(run, StructType([*rows.schema.fields, *(StructField(x, kind) for x, kind in zip(names.values(), kinds))]))


def restored(text: Column, form: Column) -> Column:
    """The text from which a transformed text of this form was made."""

    def between(mark: str, next: str) -> Column:
        begin = F.locate(mark, text) + len(mark)
        return F.substring(text, begin, F.locate(next, text) - begin)

    middle = F.substring(text, F.locate(MIDDLE, text) + len(MIDDLE), F.length(text))
    psm = F.concat(between(PREFIX, SUFFIX), middle, between(SUFFIX, MIDDLE))
    spm = F.concat(between(PREFIX, MIDDLE), middle, between(SUFFIX, PREFIX))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(text)
