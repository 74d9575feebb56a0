"""How filters overlap, for every order in which they could run, by decision diagrams.

What a document fails is a mask of one bit a filter. For each part of the corpus the masks are counted, and their counts
make a diagram with a level for each filter: a node stands for the documents with the outcomes on its way, its low
branch for those that pass the level's filter, its high branch for those that fail it, and it carries the number of its documents.
Equal diagrams are one node. Two neighbouring levels are swapped by exchanging the inner two of four grandchildren, and
swaps lead from one order to the next through all of them. In each order the path of low branches, on which all filters
pass, gives what every step keeps and removes.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfmark.llm.tables import written

# Orders are listed in full, so filters are few.
MOST_FILTERS = 7
SPACES = r"[\x20\x09-\x0D]+"

Weight = tuple[int, ...]


def plain_changes(n: int) -> Iterator[int]:
    """Places of the neighbours to swap, one after the other, to go through all orders of n things once."""
    if n < 2:
        return
    # the last thing wanders through each order of the others, which make a step whenever it stands at an end
    down, up = list(range(n - 2, -1, -1)), list(range(n - 1))
    yield from down
    left = True
    for step in plain_changes(n - 1):
        yield step + 1 if left else step
        yield from up if left else down
        left = not left


class Diagram:
    """A count-weighted decision diagram over failure masks.

    Nodes are (low, high) pairs of node numbers, shared by a table for each level; a leaf is a weight. Every way has all
    levels, so the weight of a node is the sum over its masks.
    """

    def __init__(self, names: str | list[str], counts: dict[int, Weight]):
        self.order = list(names)
        self.zero = tuple(0 for _ in next(iter(counts.values()))) if counts else (0,)
        self.children: list[tuple[int, int] | None] = []
        self.weights: list[Weight] = []
        self.known: dict[object, int] = {}
        nodes = [self._leaf(counts.get(mask, self.zero)) for mask in range(1 << len(self.order))]
        # bit k of a mask belongs to the filter at level k: the last level joins masks that differ in the highest bit
        for _ in self.order:
            half = len(nodes) // 2
            nodes = [self._node(nodes[k], nodes[k + half]) for k in range(half)]
        self.root = nodes[0]

    def _leaf(self, weight: Weight) -> int:
        return self._numbered(weight, None, weight)

    def _node(self, low: int, high: int) -> int:
        return self._numbered((low, high), (low, high), tuple(a + b for a, b in zip(self.weights[low], self.weights[high])))

    def _numbered(self, key: object, children: tuple[int, int] | None, weight: Weight) -> int:
        # leaves and nodes never share a key: a leaf's key is marked
        key = (children is None, key)
        if key not in self.known:
            self.known[key] = len(self.weights)
            self.children.append(children)
            self.weights.append(weight)
        return self.known[key]

    def swap(self, level: int) -> None:
        """Exchanges a level with the next one; only nodes of these two levels are made anew."""
        done: dict[tuple[int, int], int] = {}

        def rebuilt(node: int, depth: int) -> int:
            if (node, depth) not in done:
                low, high = self.children[node]
                if depth < level:
                    done[node, depth] = self._node(rebuilt(low, depth + 1), rebuilt(high, depth + 1))
                else:
                    (a, b), (c, d) = self.children[low], self.children[high]
                    done[node, depth] = self._node(self._node(a, c), self._node(b, d))
            return done[node, depth]

        self.root = rebuilt(self.root, 0)
        self.order[level], self.order[level + 1] = self.order[level + 1], self.order[level]

    def steps(self) -> Iterator[tuple[str, Weight, Weight]]:
        """(filter, weight kept, weight removed) along the way on which all filters pass."""
        node = self.root
        for name in self.order:
            low, high = self.children[node]
            yield name, self.weights[low], self.weights[high]
            node = low

    def failing(self) -> dict[str, Weight]:
        """All documents that fail each filter, whatever else they fail."""
        out, level = {}, [(self.root, 1)]
        for name in self.order:
            total, below = self.zero, {}
            for node, times in level:
                low, high = self.children[node]
                total = tuple(t + times * w for t, w in zip(total, self.weights[high]))
                for child in (low, high):
                    below[child] = below.get(child, 0) + times
            out[name], level = total, list(below.items())
        return out

    def only(self) -> dict[str, Weight]:
        """Documents that fail one filter and pass all others."""
        out = {}
        for k, name in enumerate(self.order):
            node = self.root
            for j in range(len(self.order)):
                node = self.children[node][j == k]
            out[name] = self.weights[node]
        return out


STEP_COLUMNS = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


def order_steps(names: list[str], counts: dict[int, Weight]) -> list[tuple]:
    """(order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley) for every order of the filters.

    ``counts`` gives (documents, good ones, toxic ones) of each mask; bit k of a mask belongs to filter k.
    """
    diagram = Diagram(names, counts)
    failing, only = diagram.failing(), diagram.only()
    shapley = dict.fromkeys(names, 0)
    rows = []

    def read() -> None:
        order = "".join(diagram.order)
        for step, (name, kept, removed) in enumerate(diagram.steps(), 1):
            shapley[name] += removed[0]
            rows.append((order, step, name, kept[0], removed[0], failing[name][0] - removed[0], only[name][0], removed[1], removed[2]))

    read()
    for level in plain_changes(len(names)):
        diagram.swap(level)
        read()
    return [(order, step, *rest, shapley[name]) for order, step, name, *rest in rows]


def audit_masks(counts: DataFrame, names: list[str]) -> DataFrame:
    """(part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley).

    ``counts`` has one row per (part, mask) with n, good and toxic; a part has at most 2**filters rows, so a task holds a
    small table for each part whatever the corpus. Parts are spread over the cluster. Masks without documents are zero; no
    row for a part gives no rows for it.
    """
    if not 1 <= len(names) <= MOST_FILTERS or len("".join(names)) != len(names) or len(set(names)) != len(names):
        raise ValueError(f"filters are told apart by one letter each, {MOST_FILTERS} at most")
    columns = ["filter_order", "step", *STEP_COLUMNS]

    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        weights = {int(m): (int(n), int(g), int(t)) for m, n, g, t in zip(rows["mask"], rows["n"], rows["good"], rows["toxic"])}
        out = pd.DataFrame(order_steps(names, weights), columns=columns)
        out.insert(0, "part", key[0])
        return out

    schema = "part string, filter_order string, step int, " + ", ".join(f"{c} long" for c in STEP_COLUMNS)
    return counts.select("part", "mask", "n", "good", "toxic").groupBy("part").applyInPandas(run, schema)


def text_failures(text: Column) -> dict[str, Column]:
    """Conditions under which a text fails filters A to D: few words, repeated words, capitals, signs.

    A: under 200 words. B: fewer than half of the words differ. C: more than 2 % of the code points are A-Z. D: holds one of
    ``#$%&*|``. Words are runs without white space (space and U+0009 to U+000D).
    """
    words = F.array_remove(F.split(text, SPACES), "")
    n = F.size(words)
    capitals = F.length(text) - F.length(F.regexp_replace(text, "[A-Z]", ""))
    return {
        "A": n < 200,
        "B": 100 * F.size(F.array_distinct(words)) < 50 * n,
        "C": 100 * capitals > 2 * F.length(text),
        "D": text.rlike(r"[#$%&*|]"),
    }


def _mask(failures: list[Column]) -> Column:
    total = F.lit(0)
    for k, failed in enumerate(failures):
        total = total + F.when(failed, 1 << k).otherwise(0)
    return total


def audit_filters(documents: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", part: str = "source") -> DataFrame:
    """The five filters A to E (``text_failures``; E: identical to the text of any smaller id) in all 120 orders, for each part.

    Columns as in ``audit_masks``. Parts are the values of ``part`` as text; null is the empty text. Null texts are empty, and two
    empty texts are identical. A row without an id fails E never and is no smaller id for others; rows that share the
    smallest id of a text all pass. A document is good or toxic if any row of ``labels`` (doc_id, quality, toxic) says so.
    Repeated rows are documents of their own. An empty table gives no rows.

    A scan turns every text into a narrow row (id, part, mask, hash of 256 bits), written once. The rows with the smallest id
    of each text are found by a rank that Spark cuts in every task, so a text that a third of all documents share sends a row
    for each task; masks are counted before the shuffle.
    """
    body = F.coalesce(documents[text].cast("string"), F.lit(""))
    rows = documents.select(documents[id].alias("id"), F.coalesce(documents[part].cast("string"), F.lit("")).alias("part"), body.alias("text"))
    failures = text_failures(F.col("text"))
    facts = written(rows.select("id", "part", _mask(list(failures.values())).alias("mask"), F.unhex(F.sha2(F.col("text").cast("binary"), 256)).alias("h")))
    known = labels.groupBy(labels["doc_id"].alias("id")).agg(
        F.max(F.when(F.col("quality") == 1, 1).otherwise(0)).alias("good"), F.max(F.when(F.col("toxic") == 1, 1).otherwise(0)).alias("toxic")
    )
    known = known.filter("good + toxic > 0")
    smallest = Window.partitionBy("h").orderBy("id")
    first = facts.filter("id IS NOT NULL").withColumn("r", F.rank().over(smallest)).filter("r = 1").select("id", "part", "mask")
    passing = first.unionByName(facts.filter("id IS NULL").select("id", "part", "mask"))
    failed = 1 << len(failures)
    # every row fails E at first; those that pass are moved to the mask without it
    moved = facts.select("id", "part", (F.col("mask") + failed).alias("mask"), F.lit(1).alias("n"))
    for sign, bit in ((1, 0), (-1, failed)):
        moved = moved.unionByName(passing.select("id", "part", (F.col("mask") + bit).alias("mask"), F.lit(sign).alias("n")))
    counts = moved.join(known, "id", "left").groupBy("part", "mask").agg(
        F.sum("n").alias("n"), F.sum(F.col("n") * F.coalesce("good", F.lit(0))).alias("good"), F.sum(F.col("n") * F.coalesce("toxic", F.lit(0))).alias("toxic")
    )
    return audit_masks(counts, [*failures, "E"])
