"""Allow and block rules for web addresses, matched by a broadcast trie.

The trie goes down the host from its last label (``org``, ``example``, ...) and from there down the
path, segment by segment. A rule fits its host and every subdomain of it if the path of the address
starts with the path of the rule; the last segment of a rule may be the start of a longer segment.
The rule with the most host labels wins, then the one with the longest path; of an allow and a block
entry for one and the same address prefix, the block entry wins.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyweave.llm.frames import lower_ascii


class Rule(NamedTuple):
    verdict: str  # "allow" or "block"
    host: str
    path: str = ""

    @property
    def name(self) -> str:
        return self.host + self.path


class UrlTrie:
    """Nested dictionaries: ``{label: node}`` for hosts, ``{segment: node}`` for paths.

    Its size is that of the rule list, which the caller holds in memory to begin with.
    """

    def __init__(self, rules: Iterable[Rule] = ()):
        self.root: dict = {}
        for rule in rules:
            self.add(rule)

    def add(self, rule: Rule) -> None:
        if rule.verdict not in ("allow", "block"):
            raise ValueError(f"verdict {rule.verdict!r} is neither allow nor block")
        if rule.path and not rule.path.startswith("/"):
            raise ValueError(f"path {rule.path!r} does not start with /")
        node = self.root
        for label in reversed(rule.host.lower().split(".")):
            node = node.setdefault("labels", {}).setdefault(label, {})
        node = node.setdefault("paths", {})
        if not rule.path:
            self._put(node, "whole", rule)
            return
        *inner, last = rule.path[1:].split("/")
        for segment in inner:
            node = node.setdefault("segments", {}).setdefault(segment, {})
        self._put(node.setdefault("starts", {}), last, rule)

    @staticmethod
    def _put(slots: dict, key: str, rule: Rule) -> None:
        if key not in slots or rule.verdict == "block":
            slots[key] = rule

    def find(self, host: str, path: str) -> Rule | None:
        """The most specific rule that fits, or None."""
        best, node = None, self.root
        for label in reversed(host.split(".")):
            node = node.get("labels", {}).get(label)
            if node is None:
                break
            if "paths" in node:
                best = self._find_path(node["paths"], path) or best
        return best

    @staticmethod
    def _find_path(node: dict, path: str) -> Rule | None:
        best = node.get("whole")
        if not path.startswith("/"):
            return best
        for segment in path[1:].split("/"):
            starts = node.get("starts", {})
            if starts:
                fits = (segment[:n] for n in range(len(segment), -1, -1))
                best = next((starts[s] for s in fits if s in starts), best)
            node = node.get("segments", {}).get(segment)
            if node is None:
                break
        return best


def host_of(url: Column) -> Column:
    return lower_ascii(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def judge_urls(
    pages: DataFrame, rules: Iterable[Rule], url: str = "url", keep: tuple[str, ...] = ("page_id",), default: str = "allow"
) -> DataFrame:
    """Columns ``keep`` with host, path, rule and verdict; one row per input row.

    A null address and one without ``://`` have an empty host and path, fit no rule and get
    ``default``. Other input columns are not read, so their names do not matter. Repeated rows are
    judged one by one. An empty rule list gives ``default`` throughout.
    """
    spark = pages.sparkSession
    trie = spark.sparkContext.broadcast(UrlTrie(rules))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = trie.value.find
        for batch in batches:
            hosts, paths = batch.column("host").to_pylist(), batch.column("path").to_pylist()
            found = [find(h, p) for h, p in zip(hosts, paths, strict=True)]
            columns = [batch.column(c) for c in batch.schema.names]
            columns.append(pa.array([r and r.name for r in found], pa.string()))
            columns.append(pa.array([r.verdict if r else default for r in found], pa.string()))
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, "rule", "verdict"])

    parts = pages.select(*keep, host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"))
    schema = T.StructType([*parts.schema.fields, T.StructField("rule", T.StringType()), T.StructField("verdict", T.StringType())])
    return parts.mapInArrow(run, schema)
