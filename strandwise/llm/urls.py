"""URL verdicts from a trie over reversed host labels and path segments."""

from __future__ import annotations

from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Most rules and characters of rules that the trie takes; it is broadcast, so it has to stay small (about 100 MB).
MOST_RULES, MOST_CHARS = 1_000_000, 50_000_000


@dataclass
class _Node:
    labels: dict[str, _Node] = field(default_factory=dict)
    segments: dict[str, _Node] = field(default_factory=dict)
    #: rules that end here: the last, perhaps partial, segment -> (rule, verdict)
    ends: dict[str, tuple[str, str]] = field(default_factory=dict)
    #: lengths of the keys of ends, so that a walk looks up one key a length, however many rules end here
    lengths: set[int] = field(default_factory=set)


class UrlTrie:
    """Rules (verdict, "host/path") by reversed host labels, then whole path segments, then the start of one more.

    A rule fits its host, all subdomains, and every path that starts with the rule's. The longest fitting rule wins:
    more host labels first, then the longer path. Of two rules with one and the same host and path, block wins.
    """

    def __init__(self, rules: list[tuple[str, str]]):
        if len(rules) > MOST_RULES or sum(len(r) for _, r in rules) > MOST_CHARS:
            raise ValueError(f"over {MOST_RULES} rules or {MOST_CHARS} characters")
        self.root = _Node()
        for verdict, rule in rules:
            if verdict not in ("allow", "block"):
                raise ValueError(f"unknown verdict {verdict}")
            host, slash, path = rule.partition("/")
            node = self.root
            for label in reversed(host.lower().split(".")):
                node = node.labels.setdefault(label, _Node())
            *whole, last = (slash + path)[1:].split("/") if slash else [""]
            for segment in whole:
                node = node.segments.setdefault(segment, _Node())
            key = ("/" + last) if slash and not whole else last
            if node.ends.get(key, ("", ""))[1] != "block":
                node.ends[key] = (rule, verdict)
                node.lengths.add(len(key))

    def find(self, host: str, path: str) -> tuple[str, str] | None:
        """(rule, verdict) of the longest fitting rule."""
        best, node = None, self.root
        for label in reversed(host.split(".")) if host else ():
            node = node.labels.get(label)
            if node is None:
                break
            best = self._path(node, path) or best
        return best

    @staticmethod
    def _path(node: _Node, path: str) -> tuple[str, str] | None:
        best, rest = None, path
        while True:
            fits = max((n for n in node.lengths if n <= len(rest) and rest[:n] in node.ends), default=None)
            if fits is not None:
                best = node.ends[rest[:fits]]
            segment, slash, after = rest.removeprefix("/").partition("/") if rest is path else rest.partition("/")
            if not slash or (rest is path and not path.startswith("/")):
                return best
            node = node.segments.get(segment)
            if node is None:
                return best
            rest = after


def url_host(url: Column) -> Column:
    """Host: after the first :// up to /, ?, # or the end, A-Z lower-cased; null or no ://: empty."""
    found = F.regexp_extract(F.coalesce(url.cast("string"), F.lit("")), "(?s)^.*?://([^/?#]*)", 1)
    return F.translate(found, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def url_path(url: Column) -> Column:
    """Path: after the host up to ?, # or the end; null or no ://: empty."""
    return F.regexp_extract(F.coalesce(url.cast("string"), F.lit("")), "(?s)^.*?://[^/?#]*([^?#]*)", 1)


def judge_urls(pages: DataFrame, rules: list[tuple[str, str]], default: str = "allow") -> DataFrame:
    """pages with host, path, rule and verdict added (columns of these names are replaced).

    The trie goes out as a broadcast variable and each batch of urls walks it. Urls that no rule fits, null and odd urls
    among them, have a null rule and the default verdict. Rows stay as they are, repeated ones too.
    """
    trie = pages.sparkSession.sparkContext.broadcast(UrlTrie(rules))

    @F.pandas_udf("rule string, verdict string")
    def find(host: pd.Series, path: pd.Series) -> pd.DataFrame:
        found = [trie.value.find(h, p) or (None, default) for h, p in zip(host, path, strict=True)]
        return pd.DataFrame(found, columns=["rule", "verdict"])

    kept = F.struct(*[F.col(f"`{c}`") for c in pages.columns if c not in ("host", "path", "rule", "verdict")])
    out = pages.select(kept.alias("_row"), url_host(pages["url"]).alias("host"), url_path(pages["url"]).alias("path")).withColumn("_found", find("host", "path"))
    return out.select("_row.*", "host", "path", F.col("_found.rule").alias("rule"), F.col("_found.verdict").alias("verdict"))


def without_blocked(pages: DataFrame, rules: list[tuple[str, str]]) -> DataFrame:
    """The rows of pages that aren't blocked, columns as given."""
    names = pages.columns
    tagged = pages.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("_row"), "url")
    return judge_urls(tagged, rules).filter("verdict <> 'block'").select("_row.*")


#: The rules of the query.
RULES = [("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/")]

URLS_SQL = """
WITH parts AS (
  SELECT page_id,
         translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path
  FROM pages),
rules(verdict, rule, rule_host, rule_path) AS (
  VALUES ('allow', 'org/', 'org', '/'), ('block', 'example.org/es/', 'example.org', '/es/'), ('block', 'example.org/en/1', 'example.org', '/en/1'),
         ('allow', 'com/fr/', 'com', '/fr/'), ('block', 'com/de/', 'com', '/de/')),
fits AS (
  SELECT host, path, arg_max(rule, length(rule)) AS rule, arg_max(verdict, length(rule)) AS verdict
  FROM (SELECT DISTINCT host, path FROM parts) JOIN rules
    ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
  GROUP BY host, path)
SELECT p.page_id, p.host, p.path, f.rule, coalesce(f.verdict, 'allow') AS verdict
FROM parts p LEFT JOIN fits f ON p.host = f.host AND p.path = f.path
"""
