"""Allow and block rules on web addresses: a trie over reversed host labels, then over path segments."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.tables import free_name

MOST_RULES = 1_000_000

# (verdict, host, path)
Rule = tuple[str, str, str]


def host_of(url: Column | str) -> Column:
    """From the first ``://`` to the next ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without ``://`` or for null."""
    host = F.regexp_extract(F.coalesce(F.col(url) if isinstance(url, str) else url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column | str) -> Column:
    """After the host up to ``?``, ``#`` or the end; empty without ``://`` or for null."""
    return F.regexp_extract(F.coalesce(F.col(url) if isinstance(url, str) else url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


class Trie:
    """Rules by host labels from the last one on; each host node holds a trie of path segments.

    A path node stands for a prefix that ends with a slash. A rule's rest after its last slash is kept at that node and
    compared as a text prefix. More host labels win over fewer, then the longer path.
    """

    def __init__(self, rules: Sequence[Rule]):
        self.root: dict = {}
        for verdict, host, path in rules:
            if verdict not in ("allow", "block"):
                raise ValueError(f"unknown verdict {verdict}")
            node = self.root
            for label in reversed(host.lower().split(".")) if host else ():
                node = node.setdefault(("label", label), {})
            node = node.setdefault("paths", {})
            *whole, rest = path.split("/")
            for segment in whole:
                node = node.setdefault(("segment", segment), {})
            # of two equal rules, the blocking one holds
            old = node.setdefault("rules", {}).get(rest)
            if old is None or old[0] == "allow":
                node["rules"][rest] = (verdict, host + path)

    def longest(self, host: str, path: str) -> tuple[str, str] | None:
        """(verdict, rule) of the longest rule that fits, or None."""
        best, node = self._path(self.root, path), self.root
        for label in reversed(host.split(".")) if host else ():
            node = node.get(("label", label))
            if node is None:
                break
            best = self._path(node, path) or best
        return best

    @staticmethod
    def _path(node: dict, path: str) -> tuple[str, str] | None:
        node, best, at = node.get("paths"), None, 0
        while node is not None:
            rest = path[at:]
            fits = [x for x in node.get("rules", ()) if rest.startswith(x)]
            if fits:
                best = node["rules"][max(fits, key=len)]
            end = path.find("/", at)
            if end < 0:
                break
            node, at = node.get(("segment", path[at:end])), end + 1
        return best


def judge_urls(pages: DataFrame, rules: Sequence[Rule], url: str = "url", default: str = "allow") -> DataFrame:
    """All columns of ``pages`` with ``host``, ``path``, ``rule`` and ``verdict`` (columns of these names are replaced).

    ``rules`` is a list on the driver, so its size is known: the trie is broadcast, and more than ``MOST_RULES`` rules are
    refused. An address without a fitting rule gets ``default`` and a null rule; so do null and empty addresses.
    Rows keep their number: repeated rows are judged one by one. No shuffle.
    """
    if len(rules) > MOST_RULES:
        raise ValueError(f"{len(rules)} rules are too many for a broadcast trie")
    trie = pages.sparkSession.sparkContext.broadcast(Trie(rules))

    @F.pandas_udf("struct<verdict:string,rule:string>")
    def found(parts: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        longest = trie.value.longest
        for hosts, paths in parts:
            yield pd.DataFrame([longest(h, p) or (default, None) for h, p in zip(hosts, paths)], columns=["verdict", "rule"], dtype=object)

    name = free_name(pages, "_found")
    rows = pages.withColumns({"host": host_of(url), "path": path_of(url)}).withColumn(name, found("host", "path"))
    return rows.withColumns({"rule": F.col(f"{name}.rule"), "verdict": F.col(f"{name}.verdict")}).drop(name)
