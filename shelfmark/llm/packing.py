"""Packing documents into token sequences by multiway differencing (Karmarkar and Karp).

Ids of a document and its end id are cut into whole sequences; what is left is cut into parts of at most a quarter of a
sequence and gathered in groups. A group's parts are spread over windows: every part is a partial partition of its own,
and the two partitions with the largest spread are merged again and again, the fullest windows of one onto the emptiest of
the other. When a window exceeds the capacity, the group is dealt again over one window more.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from shelfmark.llm.tables import slices

CAPACITY = 2048
# Windows that a full group is dealt over, and the tokens by which its total stays below their capacity for each.
WINDOWS = 128
SLACK = 10

COLUMNS = "start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def differencing(sizes: list[int], windows: int) -> np.ndarray:
    """Window of each part, with nearly equal sums."""
    # a node: sums in falling order, and how it came from two others (their windows in that order) or from one part
    heap = [(-size, i, np.array([size] + [0] * (windows - 1)), i) for i, size in enumerate(sizes)]
    heapq.heapify(heap)
    while len(heap) > 1:
        _, tie, left, of_left = heapq.heappop(heap)
        _, _, right, of_right = heapq.heappop(heap)
        sums = left + right[::-1]  # the fullest of one meets the emptiest of the other
        order = np.argsort(-sums, kind="stable")
        sums = sums[order]
        heapq.heappush(heap, (int(sums[-1] - sums[0]), tie, sums, (of_left, of_right, order)))
    window = np.zeros(len(sizes), np.int64)
    below = [(heap[0][3], np.arange(windows))] if heap else []
    while below:
        node, names = below.pop()
        if isinstance(node, int):
            window[node] = names[0]
            continue
        of_left, of_right, order = node
        for child, places in ((of_left, order), (of_right, windows - 1 - order)):
            own = np.empty(windows, np.int64)
            own[places] = names
            below.append((child, own))
    return window


def fitting(sizes: list[int], capacity: int) -> list[list[int]]:
    """Parts of each window within the capacity; the number of windows rises from the least possible one."""
    windows = max(1, -(-sum(sizes) // capacity))
    while True:
        window = differencing(sizes, windows)
        if np.bincount(window, sizes, windows).max() <= capacity:
            return [x for x in (np.flatnonzero(window == k).tolist() for k in range(windows)) if x]
        windows += 1


class Packer:
    """Pieces of the documents of one task. Rows come out as soon as a sequence is settled."""

    def __init__(self, capacity: int, first_sequence: int):
        self.capacity, self.sequence = capacity, first_sequence
        self.full = WINDOWS * (capacity - min(SLACK, capacity // 8))
        self.most = max(1, capacity // 4)
        self.open: list[tuple[object, int, np.ndarray, int]] = []
        self.total = 0
        self.rows: list[tuple] = []

    def place(self, doc: object, start: int, ids: np.ndarray, whole: int, offset: int) -> None:
        self.rows.append((doc, start, len(ids), zlib.crc32(ids.tobytes()), whole, self.sequence, offset))

    def add(self, doc: object, ids: np.ndarray) -> None:
        """Takes all ids of a document (little-endian unsigned 32-bit)."""
        whole, at = len(ids), 0
        while whole - at >= self.capacity:
            self.place(doc, at, ids[at : at + self.capacity], whole, 0)
            self.sequence += 1
            at += self.capacity
        while at < whole:
            end = min(whole, at + self.most, at + self.full - self.total)
            self.open.append((doc, at, ids[at:end], whole))
            self.total += end - at
            at = end
            if self.total == self.full:
                self.close()

    def close(self) -> None:
        """Deals out the open parts."""
        for parts in fitting([len(x[2]) for x in self.open], self.capacity) if self.open else ():
            offset = 0
            for i in parts:
                doc, start, ids, whole = self.open[i]
                self.place(doc, start, ids, whole, offset)
                offset += len(ids)
            self.sequence += 1
        self.open, self.total = [], 0

    def take(self) -> list[tuple]:
        rows, self.rows = self.rows, []
        return rows


_TOKENIZERS: dict[str, object] = {}


def _tokenizer(name: str, ranks: dict[bytes, int], special: dict[str, int], pattern: str):
    import tiktoken

    if name not in _TOKENIZERS:
        _TOKENIZERS.clear()
        _TOKENIZERS[name] = tiktoken.Encoding(name, pat_str=pattern, mergeable_ranks=ranks, special_tokens=special)
    return _TOKENIZERS[name]


def read_vocabulary(path: str) -> tuple[dict[bytes, int], dict[str, int]]:
    """(token bytes and ids, special tokens and ids) of a byte-level BPE tokenizer file whose ids follow its merges."""
    import json

    with open(path, encoding="utf-8") as file:
        model = json.load(file)
    # the printable stand-ins of bytes: the printable ones themselves, the others counted up from 256
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    signs = {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in plain)}
    special = {t["content"]: t["id"] for t in model["added_tokens"]}
    vocabulary = {t: i for t, i in model["model"]["vocab"].items() if t not in special}
    ranks = {bytes(signs[c] for c in token): i for token, i in vocabulary.items()}
    made = [vocabulary["".join(pair)] for pair in model["model"]["merges"]]
    if made != sorted(made):
        raise ValueError("ids don't follow the merges")
    return ranks, special


def pack_documents(
    documents: DataFrame, path: str, pattern: str, capacity: int = CAPACITY, end_id: int = 1, id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row per piece: (id, start, length, ids_crc32, doc_tokens, sequence_id, offset).

    ``path`` is a byte-level BPE tokenizer file, read on the driver and broadcast (its size is that of a vocabulary);
    ``pattern`` cuts texts into the stretches that merges don't cross. Null texts are empty and consist of the end id
    alone. Repeated rows are packed one by one. An empty table gives no rows. A task packs the rows of its input split and
    numbers its sequences from its own range, so there is no shuffle, and a task that runs again gives the same rows.
    Whole sequences and groups of ``WINDOWS`` windows are settled at once; only a task's last group may be smaller.
    """
    ranks, special = read_vocabulary(path)
    shared = documents.sparkSession.sparkContext.broadcast((ranks, special))
    rows = documents.select(documents[id].alias("id"), documents[text].cast("string").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    name = f"{path}/{capacity}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = _tokenizer(name, *shared.value, pattern)
        packer = Packer(capacity, TaskContext.get().partitionId() << 40)
        end = np.array([end_id], np.uint32)

        def output() -> pa.RecordBatch:
            columns = list(zip(*packer.take())) or [()] * 7
            return pa.RecordBatch.from_arrays(
                [pa.array(columns[0], kinds), *(pa.array(x, pa.int64()) for x in columns[1:])],
                ["id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"],
            )

        kinds = None
        for batch in batches:
            kinds = batch.schema.field("id").type
            for part, texts in slices(batch):
                for doc, body in zip(part.column("id").to_pylist(), texts.to_pylist()):
                    ids = tokenizer.encode_to_numpy(body, allowed_special="all") if body else end[:0]
                    packer.add(doc, np.concatenate([ids.astype(np.uint32), end]))
                if packer.rows:
                    yield output()
        packer.close()
        if packer.rows:
            yield output()

    return rows.mapInArrow(run, f"id {kind}, {COLUMNS}").withColumnRenamed("id", id)
