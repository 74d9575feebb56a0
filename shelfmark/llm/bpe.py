"""Byte-level BPE: encoding by a lazily determinised transducer, decoding by a UTF-8 stream.

The encoding of a text's prefix ends with one token only, and leaving that token out gives the encoding of a shorter
prefix. So reading bytes from the left, the transducer keeps the ends of the prefixes that a longer token can still
start from, each with its last token; the tokens common to all of them are emitted. A token may follow another exactly
when merging the two texts gives the two tokens again. The state is the last emitted token and the bytes read since,
fewer than the longest token has; states and arcs are made when a text first needs them.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from shelfmark.llm.pretoken import cut_pieces
from shelfmark.llm.tables import slices

# Bounds of what a Python worker keeps. Beyond them it starts anew; results don't depend on them.
MOST_STATES = 250_000
MOST_PIECES = 400_000
LONGEST_KEPT = 48
_NEVER = 1 << 60
_BYTES = [bytes((k,)) for k in range(256)]


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and ids of a rank file (base64 token, id)."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def merged(text: bytes, ranks: dict[bytes, int], least: int = 1) -> list[bytes]:
    """Repeated merging of the first pair with the lowest id, down to ``least`` parts: the definition, used on tokens only."""
    parts = [text[i : i + 1] for i in range(len(text))]
    costs = [ranks.get(text[i : i + 2], _NEVER) for i in range(len(text) - 1)]
    while len(costs) >= least:
        rank = min(costs)
        if rank == _NEVER:
            break
        at = costs.index(rank)
        parts[at : at + 2] = [parts[at] + parts[at + 1]]
        del costs[at]
        if at:
            costs[at - 1] = ranks.get(parts[at - 1] + parts[at], _NEVER)
        if at < len(costs):
            costs[at] = ranks.get(parts[at] + parts[at + 1], _NEVER)
    return parts


class Transducer:
    """Bytes of one piece to ids. A piece that is a token as a whole is that token, whatever its merges."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.codes = {token: rank.to_bytes(4, "little") for token, rank in ranks.items()}
        # whether bytes are a token (1), the beginning of a longer one (2) or both (3)
        self.kinds = dict.fromkeys((token[:k] for token in ranks for k in range(1, len(token))), 2)
        self.kinds |= {token: 1 | self.kinds.get(token, 0) for token in ranks}
        self.follows: dict[tuple[bytes | None, bytes], bool] = {}
        self.joins: dict[bytes, tuple[bytes, bytes]] = {}
        self.grows: dict[bytes, bool] = {}
        self.reset()

    def reset(self) -> None:
        self.numbers: dict[tuple[bytes | None, bytes], int] = {}
        self.states: list[tuple[bytes | None, bytes, tuple, tuple]] = []
        self.arcs: dict[int, tuple[int, bytes]] = {}  # by 256 * state + byte
        self.final: list[bytes | None] = []
        self.state(None, b"", (), (0,))

    def state(self, before: bytes | None, pending: bytes, lasts: tuple, live: tuple) -> int:
        """Number of a state: last emitted token, bytes since, last token up to each of them, ends that may go on."""
        number = self.numbers.get((before, pending))
        if number is None:
            number = self.numbers[before, pending] = len(self.states)
            self.states.append((before, pending, lasts, live))
            self.final.append(None)
        return number

    def may_follow(self, left: bytes | None, right: bytes) -> bool:
        """Whether merging the two texts gives the two tokens; without a left one, whether the right one is ever made."""
        known = self.follows.get((left, right))
        if known is None:
            if len(self.follows) > 4 * MOST_STATES:
                self.follows.clear()
            if left is None:
                known = merged(right, self.ranks) == [right]
            elif not (self.may_follow(None, left) and self.may_follow(None, right)):
                known = False
            elif self.grown(left) and self.grown(right):
                known = self.apart(left, right)
            else:
                known = merged(left + right, self.ranks) == [left, right]
            self.follows[left, right] = known
        return known

    def apart(self, left: bytes, right: bytes) -> bool:
        """Whether no merge crosses from one token to the other, both of which grow.

        Their merges are undone from the last one on. What crosses between the parts that are neighbours then comes first if
        its id is lower than that of the merge undone last, or equal and further left.
        """
        ranks, limit = self.ranks, _NEVER
        a, b = ranks[left] if len(left) > 1 else -1, ranks[right] if len(right) > 1 else -1
        while ranks.get(left + right, _NEVER) >= limit:
            if a < 0 and b < 0:
                return True
            if a > b:
                limit, left = a, self.halves(left)[1]
                a = ranks[left] if len(left) > 1 else -1
            else:
                limit, right = b + 1, self.halves(right)[0]
                b = ranks[right] if len(right) > 1 else -1
        return False

    def halves(self, token: bytes) -> tuple[bytes, bytes]:
        """The two parts that the last merge of a token joins."""
        known = self.joins.get(token)
        if known is None:
            known = self.joins[token] = tuple(merged(token, self.ranks, 2))
        return known

    def grown(self, token: bytes) -> bool:
        """Whether all merges that make the token go by increasing ids, as in a trained vocabulary."""
        known = self.grows.get(token)
        if known is None:
            known = self.grows[token] = len(token) == 1 or all(len(x) == 1 or self.ranks[x] < self.ranks[token] and self.grown(x) for x in self.halves(token))
        return known

    def step(self, number: int, byte: int) -> tuple[int, bytes]:
        """Makes the arc of a byte."""
        before, pending, lasts, live = self.states[number]
        pending += _BYTES[byte]
        last, on, kinds, follows = None, [], self.kinds, self.follows
        for j in live:
            token = pending[j:]
            kind = kinds.get(token)
            if kind is None:
                continue
            if last is None and kind & 1:
                left = lasts[j - 1] if j else before
                known = follows.get((left, token))
                if known or known is None and self.may_follow(left, token):
                    last = token
            if kind & 2:
                on.append(j)
        lasts += (last,)
        if before is None and pending in self.ranks and on[:1] != [0]:
            on.insert(0, 0)  # the whole piece may still be one token
        if last is not None:
            on.append(len(pending))
        # the last end that all paths have in common: what is before it is settled
        cut, emitted = on[0], b""
        if cut and len(on) > 1:
            ends = 0  # a bit for each
            for j in on:
                ends |= 1 << j
            while ends & (ends - 1):
                top = ends.bit_length() - 1
                ends = ends ^ (1 << top) | 1 << (top - len(lasts[top - 1]))
            cut = ends.bit_length() - 1
        if cut:
            for token in self.path(lasts, cut):
                emitted += self.codes[token]
                before = token
            pending, lasts, on = pending[cut:], lasts[cut:], [j - cut for j in on]
        arc = self.arcs[number << 8 | byte] = (self.state(before, pending, lasts, tuple(on)), emitted)
        return arc

    @staticmethod
    def path(lasts: tuple, end: int) -> list[bytes]:
        """Tokens from the last emitted one up to ``end``."""
        tokens = []
        while end:
            tokens.append(lasts[end - 1])
            end -= len(tokens[-1])
        return tokens[::-1]

    def finish(self, number: int) -> bytes:
        """Ids that the end of the piece brings."""
        before, pending, lasts, _ = self.states[number]
        if before is None and pending in self.ranks:
            out = self.codes[pending]
        else:
            out = b"".join(self.codes[token] for token in self.path(lasts, len(pending)))
        self.final[number] = out
        return out

    def encode(self, piece: bytes) -> bytes:
        """Ids of a piece as little-endian unsigned 32-bit integers."""
        if len(self.states) > MOST_STATES:
            self.reset()
        now, out, arcs = 0, [], self.arcs
        for byte in piece:
            arc = arcs.get(now << 8 | byte) or self.step(now, byte)
            now = arc[0]
            if arc[1]:
                out.append(arc[1])
        last = self.final[now]
        out.append(self.finish(now) if last is None else last)
        return b"".join(out)


class _Pieces(dict):
    """Ids of the pieces met lately, in two generations: a full one becomes the old one."""

    def __init__(self, transducer: Transducer):
        super().__init__()
        self.transducer, self.old = transducer, {}

    def __missing__(self, piece: bytes) -> bytes:
        ids = self.old.get(piece)
        if ids is None:
            ids = self.transducer.encode(piece)
        if len(piece) <= LONGEST_KEPT:
            if len(self) >= MOST_PIECES:
                self.old = dict(self)
                self.clear()
            self[piece] = ids
        return ids


class Encoder:
    """Whole texts to ids."""

    def __init__(self, ranks: dict[bytes, int]):
        self.pieces = _Pieces(Transducer(ranks))

    def encode(self, texts: pa.Array) -> Iterator[bytes]:
        """For each text (no nulls) its ids as little-endian unsigned 32-bit integers."""
        pieces, first = cut_pieces(texts)
        ids = self.pieces.__getitem__
        for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
            yield b"".join(map(ids, pieces[a:b]))


class Decoder:
    """Ids, in any blocks, to bytes that hold whole characters only; the rest waits for the next block."""

    def __init__(self, ranks: dict[bytes, int]):
        tokens = [b""] * (max(ranks.values(), default=-1) + 1)
        for token, rank in ranks.items():
            tokens[rank] = token
        self.token = tokens.__getitem__
        self.rest = b""

    @staticmethod
    def open_bytes(data: bytes) -> int:
        """How many bytes at the end begin a character that more bytes must complete."""
        for back, byte in enumerate(reversed(data[-3:]), 1):
            if byte & 0xC0 != 0x80:
                need = 2 if byte >> 5 == 6 else 3 if byte >> 4 == 14 else 4 if byte >> 3 == 30 else 1
                return back if need > back else 0
        return 0

    def feed(self, ids: np.ndarray) -> bytes:
        data = self.rest + b"".join(map(self.token, ids.tolist()))
        cut = len(data) - self.open_bytes(data)
        self.rest = data[cut:]
        return data[:cut]

    def end(self) -> bytes:
        """What is left: bytes that never became a character."""
        out, self.rest = self.rest, b""
        return out

    def decode(self, ids: np.ndarray, block: int = 1 << 16) -> Iterator[bytes]:
        for at in range(0, len(ids), block):
            yield self.feed(ids[at : at + block])
        yield self.end()


_CODERS: dict[str, tuple[Encoder, Decoder]] = {}


def coders(ranks: dict[bytes, int], name: str) -> tuple[Encoder, Decoder]:
    """The coders of this Python worker for a vocabulary; states and pieces are kept from task to task."""
    if name not in _CODERS:
        _CODERS.clear()
        _CODERS[name] = Encoder(ranks), Decoder(ranks)
    return _CODERS[name]


def vocabulary_name(ranks: dict[bytes, int]) -> str:
    digest = hashlib.sha256()
    for token, rank in ranks.items():
        digest.update(b"%d %d " % (rank, len(token)) + token)
    return digest.hexdigest()


def encode_texts(documents: DataFrame, ranks: dict[bytes, int], id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, token_ids array<int>, decoded string): ids of every whole text and the text that they decode to.

    Null texts are empty; an empty text has no ids. Repeated rows are encoded one by one. The vocabulary has a fixed size
    and is broadcast. No shuffle.
    """

    def output(row_ids, coded, decoder):
        counts = np.fromiter((len(x) // 4 for x in coded), np.int64, len(coded))
        flat = np.frombuffer(b"".join(coded), "<u4").astype(np.int32)
        back = [b"".join(decoder.decode(np.frombuffer(x, "<u4"))) for x in coded]
        lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)), pa.array(flat))
        return pa.RecordBatch.from_arrays([row_ids, lists, pa.array([x.decode("utf-8", "replace") for x in back], pa.string())], ["id", "token_ids", "decoded"])

    return _coded(documents, ranks, id, text, "token_ids array<int>, decoded string", output)


def token_digests(documents: DataFrame, ranks: dict[bytes, int], id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256): digests of what ``encode_texts`` gives, without carrying the ids."""

    def output(row_ids, coded, decoder):
        back = []
        for ids in coded:
            digest = hashlib.sha256()
            for part in decoder.decode(np.frombuffer(ids, "<u4")):
                digest.update(part)
            back.append(digest.hexdigest())
        counts = pa.array([len(x) // 4 for x in coded], pa.int64())
        digests = pa.array([hashlib.sha256(x).hexdigest() for x in coded], pa.string())
        return pa.RecordBatch.from_arrays([row_ids, counts, digests, pa.array(back, pa.string())], ["id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return _coded(documents, ranks, id, text, "n_tokens long, ids_sha256 string, decoded_sha256 string", output)


def _coded(documents: DataFrame, ranks: dict[bytes, int], id: str, text: str, columns: str, output) -> DataFrame:
    shared = documents.sparkSession.sparkContext.broadcast(ranks)
    name = vocabulary_name(ranks)
    rows = documents.select(documents[id].alias("id"), documents[text].cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, decoder = coders(shared.value, name)
        for batch in batches:
            for part, texts in slices(batch):
                yield output(part.column("id"), list(encoder.encode(texts)), decoder)

    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"id {kind}, {columns}").withColumnRenamed("id", id)
