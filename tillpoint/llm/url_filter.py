"""Operator 6: URL filters.

Allow and block entries (host, path) live in one trie: reversed host labels
lead to path segments. The trie is broadcast (its size is checked); each URL
walks it once and the longest fitting entry decides.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_RULES = 2_000_000  # entries that may be broadcast (about 300 MB); beyond it use several filters in turn

Rule = tuple[str, str, str]  # verdict, host, path


def build_trie(rules: Iterable[Rule]) -> dict:
    """Nested dicts. A host node maps labels to host nodes, with its paths
    under None; a path node maps whole segments to path nodes, with the entries
    ending there under None as {start of the next segment: (rank, verdict,
    rule)}. Of an allow and a block entry that are equal, block stays."""
    root: dict = {}
    for verdict, host, path in rules:
        host = host.lower()
        node = root
        for label in reversed(host.split(".")):
            node = node.setdefault(label, {})
        node = node.setdefault(None, {})
        *whole, rest = path.split("/")
        for segment in whole:
            node = node.setdefault(segment, {})
        rank = (len(host) + len(path), host.count("."))
        ends = node.setdefault(None, {})
        if ends.get(rest, ("", "allow"))[1] == "allow":
            ends[rest] = rank, verdict, host + path
    return root


def longest_match(trie: dict, host: str, path: str) -> tuple[str | None, str | None]:
    """(rule, verdict) of the longest entry that fits, or (None, None). Of two
    of the same length the one with more host labels wins."""
    best: tuple = ((-1, -1), None, None)
    node, segments = trie, path.split("/")
    for label in reversed(host.split(".")):
        node = node.get(label)
        if node is None:
            break
        below = node.get(None)
        for i, segment in enumerate(segments):
            if below is None:
                break
            for start, found in below.get(None, {}).items():
                if found[0] > best[0] and "/".join(segments[i:]).startswith(start):
                    best = found
            below = below.get(segment)
    return best[2], best[1]


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z
    lower-cased; null or without ``://``: empty."""
    rest = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(rest, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def filter_urls(pages: DataFrame, rules: Iterable[Rule], key: str = "page_id", url: str = "url", default: str = "allow") -> DataFrame:
    """(key, host, path, rule, verdict), one row per input row, repeats and
    null keys included. An entry fits its host and every subdomain when the
    path starts with the entry's path; the longest entry wins; ``default``
    where none fits (null and relative URLs have an empty host and path).
    Other columns are not read.
    """
    rules = list(rules)
    if len(rules) > MAX_RULES:
        raise ValueError(f"{len(rules)} rules; at most {MAX_RULES} can be broadcast")
    trie = pages.sparkSession.sparkContext.broadcast(build_trie(rules))

    @F.pandas_udf("rule string, verdict string")
    def match(parts: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for host, path in parts:
            pairs = list(zip(host, path))
            walked = {pair: longest_match(trie.value, *pair) for pair in set(pairs)}  # once for each URL of the batch
            found = [walked[pair] for pair in pairs]
            yield pd.DataFrame({"rule": [r for r, _ in found], "verdict": [v for _, v in found]}, dtype=object)

    parts = pages.select(F.col(key), host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"))
    return (parts.withColumn("m", match("host", "path"))
            .select(key, "host", "path", "m.rule", F.coalesce("m.verdict", F.lit(default)).alias("verdict")))
