"""Language of a text by cross-parsing: the language whose labelled text needs the fewest phrases to spell it.

For each language a suffix automaton of a sample of labelled text follows a text as long as some stretch of the sample
goes on in the same way; where it doesn't, a phrase ends and the next one begins. Phrases count log2 of the sample's
length each, over the number of characters: the cross-parsing entropy.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfmark.llm.letters import letters_of
from shelfmark.llm.tables import row_keys, slices

# Bounds of what is learned from: stretches a language, characters of a stretch, and stretches that one text may give. Texts are
# cut into stretches from beginning to end, and hashes choose among all of them.
STRETCHES = 64
STRETCH = 500
SHARE = 8
# Languages whose automata are broadcast together; more languages are parsed in more passes over the texts.
TOGETHER = 16
# Long texts are parsed in blocks of this many characters side by side; a phrase ends at the end of a block in every language.
BLOCK = 512
UNKNOWN = "und"


class SuffixAutomaton:
    """All substrings of a sequence of symbols, as the arcs of a deterministic automaton."""

    def __init__(self, symbols: list[int]):
        self.arcs: list[dict[int, int]] = [{}]
        link, length, last = [-1], [0], 0
        for c in symbols:
            new = len(self.arcs)
            self.arcs.append({})
            length.append(length[last] + 1)
            link.append(0)
            p = last
            while p >= 0 and c not in self.arcs[p]:
                self.arcs[p][c] = new
                p = link[p]
            if p >= 0:
                q = self.arcs[p][c]
                if length[q] == length[p] + 1:
                    link[new] = q
                else:
                    copy = len(self.arcs)
                    self.arcs.append(dict(self.arcs[q]))
                    length.append(length[p] + 1)
                    link.append(link[q])
                    link[q] = link[new] = copy
                    while p >= 0 and self.arcs[p].get(c) == q:
                        self.arcs[p][c] = copy
                        p = link[p]
            last = new


def spelled(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(symbols, first): lower-cased letters of each text, other runs as one 0; texts without a letter are empty."""
    letters, first = letters_of(texts)
    if not len(letters):
        return letters, first
    keep = letters > 0
    keep[1:] |= letters[:-1] > 0
    opens = first[:-1][first[:-1] < len(letters)]
    keep[opens] = letters[opens] > 0
    total = np.concatenate([[0], np.cumsum(keep)])
    return letters[keep], total[first]


class Parser:
    """The automata of all languages as one table: for a state and a symbol the next state and whether a phrase begins."""

    def __init__(self, samples: dict[str, np.ndarray]):
        self.languages = sorted(samples)
        self.alphabet = np.unique(np.concatenate([samples[x] for x in self.languages])) if samples else np.zeros(0, np.uint32)
        # symbols: those of the samples, then any other, then the filling after a block's end
        self.other, self.fill = len(self.alphabet), len(self.alphabet) + 1
        width = len(self.alphabet) + 2
        tables, self.roots, base = [], [], 0
        self.bits = np.array([max(1.0, np.log2(len(samples[x]))) for x in self.languages])
        for language in self.languages:
            arcs = SuffixAutomaton(np.searchsorted(self.alphabet, samples[language]).tolist()).arcs
            table = np.full((len(arcs), width), -1, np.int64)
            for state, out in enumerate(arcs):
                table[state, list(out)] = list(out.values())
            # a phrase begins where none is open (at the root) and where the open one cannot go on; a symbol that the
            # sample doesn't hold is a phrase of its own, after which none is open
            begin = table[0].copy()
            begins = table < 0
            begins[0] = True
            table = np.where(table < 0, np.maximum(begin, 0), table)
            table = (table + base) * width * 2 + begins
            table[:, self.fill] = (np.arange(len(arcs)) + base) * width * 2
            tables.append(table)
            self.roots.append(base * width)
            base += len(arcs)
        kind = np.int32 if base * width * 2 < 2**31 else np.int64
        self.table = np.concatenate(tables).astype(kind).ravel() if tables else np.zeros(0, kind)

    def entropies(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(bits a character for each text and language, characters of each text)."""
        symbols, first = spelled(texts)
        counts = np.diff(first)
        phrases = np.zeros((len(self.languages), len(counts)))
        if len(symbols) and self.languages:
            code = np.searchsorted(self.alphabet, symbols)
            code = np.where(self.alphabet[np.minimum(code, len(self.alphabet) - 1)] == symbols, code, self.other)
            blocks = -(-counts // BLOCK)
            owner = np.repeat(np.arange(len(counts)), blocks)
            number = np.arange(len(owner)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
            begin = first[owner] + number * BLOCK
            length = np.minimum(BLOCK, first[owner + 1] - begin)
            order = np.argsort(-length, kind="stable")
            begin, length, owner = begin[order], length[order], owner[order]
            state = np.repeat(np.array(self.roots, self.table.dtype)[:, None], len(owner), axis=1)
            begun = np.zeros(state.shape, np.int32)
            for k in range(int(length[0])):
                n = int(np.searchsorted(-length, -k, side="left"))  # blocks longer than k
                step = self.table[state[:, :n] + code[begin[:n] + k].astype(self.table.dtype)]
                begun[:, :n] += step & 1
                state[:, :n] = step >> 1
            for row, own in zip(phrases, begun):
                row[:] = np.bincount(owner, own, len(counts))
        return (phrases * self.bits[:, None] / np.maximum(counts, 1)).T, counts

    def predict(self, texts: pa.Array) -> tuple[list[str], list[float], np.ndarray]:
        """(language, score, entropies) of each text; the score is the runner-up's share of the two lowest entropies."""
        bits, counts = self.entropies(texts)
        names, scores = [], []
        for row, n in zip(bits, counts):
            if not n or not len(row):
                names.append(UNKNOWN)
                scores.append(0.0)
                continue
            order = np.argsort(row, kind="stable")  # ties: the first name
            names.append(self.languages[order[0]])
            scores.append(float(row[order[1]] / (row[order[0]] + row[order[1]])) if len(row) > 1 else 1.0)
        return names, scores, bits


def sample_languages(labelled: DataFrame, text: str, lang: str) -> DataFrame:
    """(lang, parts: stretches of labelled text): a bounded sample of whole texts for each language.

    Of each text the stretches with the smallest hashes are offered, wherever they stand in it, and of all offered ones those with
    the smallest hashes are taken; equal stretches count once. Every task keeps a bounded number for each language.
    """
    rows = labelled.filter(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(F.col(lang).alias("lang"), F.col(text).cast("string").alias("text"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[str, dict[int, str]] = {}
        for batch in batches:
            for name, body in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
                parts = (body[at : at + STRETCH] for at in range(0, len(body), STRETCH))
                marked = ((int.from_bytes(hashlib.blake2b(x.encode(), digest_size=8).digest(), "little", signed=True), x) for x in parts if any(map(str.isalpha, x)))
                kept = found.setdefault(name, {})
                kept.update(heapq.nsmallest(SHARE, set(marked)))
                if len(kept) > 4 * STRETCHES:
                    found[name] = dict(sorted(kept.items())[:STRETCHES])
        names, hashes, parts = [], [], []
        for name, kept in found.items():
            for h, part in sorted(kept.items())[:STRETCHES]:
                names.append(name)
                hashes.append(h)
                parts.append(part)
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(hashes, pa.int64()), pa.array(parts, pa.string())], ["lang", "h", "part"])

    every = rows.select(F.col("lang").cast("string").alias("lang"), "text").mapInArrow(cut, "lang string, h long, part string")
    # at most STRETCHES rows a language and task; the window's group limit cuts them again before the shuffle
    kept = every.dropDuplicates(["lang", "h"]).withColumn("k", F.row_number().over(Window.partitionBy("lang").orderBy("h"))).filter(F.col("k") <= STRETCHES)
    return kept.groupBy("lang").agg(F.transform(F.array_sort(F.collect_list(F.struct("h", "part"))), lambda x: x["part"]).alias("parts"))


def symbols_of(parts: list[str]) -> np.ndarray:
    """The symbols of a language's stretches, with a 0 after each."""
    symbols, first = spelled(pa.array(parts, pa.string()))
    return np.concatenate([np.append(symbols[a:b], 0) for a, b in zip(first[:-1], first[1:])]).astype(np.uint32)


def identify_languages(documents: DataFrame, labelled: DataFrame, id: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """(id, lang_pred, score, entropies): language of each whole text of ``documents``, learned from ``labelled``.

    ``lang_pred`` is a language of ``labelled``, or ``und`` (score 0) if the text is null or has no letter, or if nothing was
    learned. Languages that need equally many bits: the first in order of their names. ``entropies`` maps each language to
    its bits a character. Repeated rows are read one by one; an empty table gives no rows. No shuffle of texts; more than
    ``TOGETHER`` languages take several passes, and their entropies meet by row.
    """
    spark = documents.sparkSession
    samples = {r["lang"]: symbols_of(r["parts"]) for r in sample_languages(labelled, text, lang).toLocalIterator()}
    names = sorted(samples)
    groups = [names[k : k + TOGETHER] for k in range(0, len(names), TOGETHER)] or [[]]
    # any number of languages: a row's entropies of several passes are put together by a key that is its own
    rows = documents.select(documents[id].alias("id"), documents[text].cast("string").alias("text"))
    rows = row_keys(rows, "id", "key") if len(groups) > 1 else rows.withColumn("key", F.lit(0).cast("long"))
    kind = rows.schema["id"].dataType.simpleString()
    passes = [_parsed(spark, rows, kind, {x: samples[x] for x in group}) for group in groups]
    if len(passes) == 1:
        return passes[0].drop("key").withColumnRenamed("id", id)
    every = passes[0]
    for part in passes[1:]:
        every = every.union(part)
    order = F.transform(F.flatten(F.collect_list(F.map_entries("entropies"))), lambda x: F.struct(x["value"].alias("bits"), x["key"].alias("name")))
    # the key is null for no row; its id may be
    one = every.groupBy("key").agg(F.min("id").alias("id"), F.array_sort(order).alias("best"))
    best, second = F.get("best", F.lit(0)), F.get("best", F.lit(1))
    return one.select(
        F.col("id").alias(id),
        F.coalesce(best["name"], F.lit(UNKNOWN)).alias("lang_pred"),
        F.coalesce(second["bits"] / (best["bits"] + second["bits"]), F.lit(0.0)).alias("score"),
        F.map_from_entries(F.transform("best", lambda x: F.struct(x["name"], x["bits"]))).alias("entropies"),
    )


def _parsed(spark: SparkSession, rows: DataFrame, kind: str, samples: dict[str, np.ndarray]) -> DataFrame:
    """(key, id, lang_pred, score, entropies) of all rows by the automata of these languages."""
    shared = spark.sparkContext.broadcast(Parser(samples))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parser = shared.value
        map_type = pa.map_(pa.string(), pa.float64())
        for batch in batches:
            for part, texts in slices(batch):
                names, scores, bits = parser.predict(texts)
                maps = [list(zip(parser.languages, row.tolist())) if name != UNKNOWN else [] for name, row in zip(names, bits)]
                yield pa.RecordBatch.from_arrays(
                    [part.column("key"), part.column("id"), pa.array(names, pa.string()), pa.array(scores, pa.float64()), pa.array(maps, map_type)],
                    ["key", "id", "lang_pred", "score", "entropies"],
                )

    return rows.mapInArrow(run, f"key long, id {kind}, lang_pred string, score double, entropies map<string,double>")
