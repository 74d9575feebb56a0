"""Places whose hash occurs at more than one place.

A task gathers places up to a bound and sorts them by hash. Places that share a hash there are settled at once; of each
hash one place goes on, in blocks by ranges of hashes, packed column by column and compressed. So a hash that a third of
all texts hold arrives as one place for each block of a task, and the shuffle carries bytes, not rows. A range holds a
bounded number of places, because hashes are uniform and ranges are as many as the texts' length asks for.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.tables import written
from shelfmark.llm.words import U

# Places that a task gathers before it packs them, and bytes of text for each range of hashes.
GATHERED = 400_000
RANGE_BYTES = 4 << 20

# A batch of places: first and second hash, document, position.
Places = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]


def ranges_for(rows: DataFrame, text: str = "text") -> int:
    """How many ranges of hashes the texts ask for."""
    size = rows.agg(F.sum(F.octet_length(text))).first()[0] or 0
    return max(1, -(-size // RANGE_BYTES))


def _planes(values: np.ndarray, drop: int = 0) -> bytes:
    """Values byte by byte, the same byte of all of them together; ``drop`` leading (low) bytes left out."""
    return values.view(np.uint8).reshape(len(values), -1).T[drop:].tobytes()


def _values(data: bytes, n: int, kind: str, drop: int = 0) -> np.ndarray:
    wide = np.zeros((np.dtype(kind).itemsize, n), np.uint8)
    wide[drop:] = np.frombuffer(data, np.uint8).reshape(-1, n)
    return np.ascontiguousarray(wide.T).view(kind).ravel()


class Packing:
    """How the columns of a block are stored: the first hash without its two low bytes, the second one in 32 bits or not at all."""

    def __init__(self, second: bool):
        self.second = second
        self.press, self.open = zstandard.ZstdCompressor(level=1), zstandard.ZstdDecompressor()

    def pack(self, h1: np.ndarray, h2: np.ndarray, doc: np.ndarray, at: np.ndarray) -> bytes:
        # hashes have no pattern to compress
        head = len(h1).to_bytes(8, "little") + _planes(h1, 0 if self.second else 2)
        if self.second:
            head += _planes(h2)
        return head + self.press.compress(_planes(doc) + _planes(at))

    def unpack(self, data: bytes) -> Places:
        n, at = int.from_bytes(data[:8], "little"), 8
        skip = 0 if self.second else 2
        h1, at = _values(data[at : at + n * (8 - skip)], n, "<u8", skip), at + n * (8 - skip)
        if self.second:
            h2, at = _values(data[at : at + n * 4], n, "<u4"), at + n * 4
        else:
            h2 = np.zeros(n, "<u4")
        rest = self.open.decompress(data[at:])
        return h1, h2, _values(rest[: 8 * n], n, "<i8"), _values(rest[8 * n :], n, "<i4")


def _ordered(places: list[Places]) -> tuple[Places, np.ndarray]:
    """(places in the order of their hashes, true where a new hash begins)."""
    h1, h2, doc, at = (np.concatenate(x) for x in zip(*places))
    order = np.lexsort((h2, h1)) if h2.any() else np.argsort(h1, kind="stable")
    h1, h2, doc, at = h1[order], h2[order], doc[order], at[order]
    new = np.ones(len(h1), bool)
    new[1:] = (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])
    return (h1, h2, doc, at), new


def _repeats(new: np.ndarray) -> np.ndarray:
    """True for places that share their hash with another."""
    alone = new.copy()
    alone[:-1] &= new[1:]
    return ~alone


def _by_document(places: Places) -> list[pa.Array]:
    """doc, at."""
    return [pa.array(places[2]), pa.array(places[3])]


def _by_hash(places: Places) -> list[pa.Array]:
    """key, doc, at."""
    return [pa.array(places[0].view(np.int64)), *_by_document(places)]


def _chosen(places: Places, which: np.ndarray) -> Places:
    return tuple(x[which] for x in places)


def _repeated(rows: DataFrame, places: Callable[[pa.RecordBatch], Iterator[Places]], ranges: int, second: bool, output: Callable, columns: str) -> DataFrame:
    low = U(0) if second else U(16)
    names = [x.split()[0] for x in columns.split(", ")]

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packing, waiting, n = Packing(second), [], 0

        def close() -> Iterator[pa.RecordBatch]:
            every, new = _ordered(waiting)
            twice = _repeats(new)
            out = output(_chosen(every, twice))
            size = len(out[0])
            yield pa.RecordBatch.from_arrays([pa.nulls(size, pa.int64()), pa.nulls(size, pa.binary()), *out], ["range", "block", *names])
            h1, h2, doc, at = every
            # a hash that is settled here needs no answer
            h1, h2, doc, at = _chosen((h1, h2, doc, np.where(twice, np.int32(-1), at)), new)
            number = ((h1 >> U(32)) * U(ranges)) >> U(32)
            cuts = np.flatnonzero(np.concatenate([[True], number[1:] != number[:-1]]))
            blocks = [packing.pack(h1[a:b], h2[a:b], doc[a:b], at[a:b]) for a, b in zip(cuts, np.append(cuts[1:], len(h1)))]
            empty = [pa.nulls(len(cuts), x.type) for x in out]
            yield pa.RecordBatch.from_arrays([pa.array(number[cuts].astype(np.int64)), pa.array(blocks, pa.binary()), *empty], ["range", "block", *names])

        for batch in batches:
            for h1, h2, doc, at in places(batch):
                if len(h1):
                    waiting.append(((h1 >> low) << low, h2.astype("<u4"), doc.astype("<i8"), at.astype("<i4")))
                    n += len(h1)
                if n >= GATHERED:
                    yield from close()
                    waiting, n = [], 0
        if n:
            yield from close()

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packing = Packing(second)

        def answer(blocks: list[bytes]) -> pa.RecordBatch:
            every, new = _ordered([packing.unpack(x) for x in blocks])
            return pa.RecordBatch.from_arrays(output(_chosen(every, _repeats(new) & (every[3] >= 0))), names)

        now, blocks = None, []
        for batch in batches:
            for number, block in zip(batch.column("range").to_pylist(), batch.column("block").to_pylist()):
                if number != now and blocks:
                    yield answer(blocks)
                    blocks = []
                now = number
                blocks.append(block)
        if blocks:
            yield answer(blocks)

    gathered = written(rows.mapInArrow(gather, f"range long, block binary, {columns}"))
    blocks = gathered.filter("range IS NOT NULL").select("range", "block").repartition("range").sortWithinPartitions("range")
    return gathered.filter("range IS NULL").select(*names).union(blocks.mapInArrow(meet, columns))


def repeated_places(rows: DataFrame, places: Callable[[pa.RecordBatch], Iterator[Places]], ranges: int, second: bool = False) -> DataFrame:
    """(doc long, at int): places, as ``places`` finds them in batches of ``rows``, whose hash occurs more than once.

    ``second`` compares 32 bits of the second hash besides the first one; without it 48 bits of the first are compared.
    """
    return _repeated(rows, places, ranges, second, _by_document, "doc long, at int")


def repeated_keys(rows: DataFrame, places: Callable[[pa.RecordBatch], Iterator[Places]], ranges: int) -> DataFrame:
    """(key long, doc long, at int): keys (48 bits of them) that occur more than once, with the documents that hold them."""
    return _repeated(rows, places, ranges, False, _by_hash, "key long, doc long, at int")
