"""Operator 1, URL filters: a trie over reversed host labels and path segments, broadcast to the tasks.

A rule is a (host, path) pair with a verdict.  It fits a URL if the URL's host is the rule's host or below it and the
URL's path starts with the rule's.  Of the rules that fit, the one with the most host labels wins, then the one with
the longest path; of an allow and a block entry for the same (host, path), the block entry wins.

Defined cases: a null URL, or one without ``://``, has an empty host and path and gets the default verdict, as do hosts
that no rule fits; rules over MAX_RULES, or with very deep paths, are joined instead of broadcast; a rule with an empty host fits every host; ports and user info count as part of the host text.
Repeated rows give repeated results; columns of the input are kept or replaced only under the names given.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sheafwork.llm.shared import ascii_lower, table

#: Rules that are broadcast as a trie, and segments of their paths (a trie is sent node in node); more are joined.
MAX_RULES, MAX_SEGMENTS = 500_000, 300


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    verdict: str

    @property
    def text(self) -> str:
        return self.host + self.path


@dataclass
class PathNode:
    """Children by whole segment (with its closing slash); tails are rule paths that end inside a segment."""

    children: dict[str, PathNode] = field(default_factory=dict)
    rule: Rule | None = None
    tails: list[tuple[str, Rule]] = field(default_factory=list)


@dataclass
class HostNode:
    children: dict[str, HostNode] = field(default_factory=dict)
    paths: PathNode | None = None


def segments(path: str) -> list[str]:
    """'/en/25' -> ['/', 'en/', '25']: the segments up to and with each slash, then the rest."""
    parts = path.split("/")
    return [f"{p}/" for p in parts[:-1]] + [parts[-1]] * bool(parts[-1])


def stronger(old: Rule | None, new: Rule) -> Rule:
    return old if old is not None and (old.verdict == "block" or new.verdict != "block") else new


def build_trie(rules: Iterable[Rule]) -> HostNode:
    root = HostNode()
    for rule in rules:
        node = root
        for label in reversed(rule.host.split(".")) if rule.host else ():
            node = node.children.setdefault(label, HostNode())
        node.paths = node.paths or PathNode()
        at = node.paths
        for seg in segments(rule.path):
            if not seg.endswith("/"):
                at.tails.append((seg, rule))
                break
            at = at.children.setdefault(seg, PathNode())
        else:
            at.rule = stronger(at.rule, rule)
    return root


def longest_path(node: PathNode, path: str) -> Rule | None:
    best = node.rule
    for seg in [*segments(path), ""]:
        tails = [(len(t), r.verdict == "block", r) for t, r in node.tails if seg.startswith(t)]
        if tails:
            best = max(tails, key=lambda x: x[:2])[2]
        if seg not in node.children:
            break
        node = node.children[seg]
        best = node.rule or best
    return best


def lookup(root: HostNode, host: str, path: str) -> Rule | None:
    """The winning rule: the deepest host node with a fitting path."""
    node, best = root, None
    labels = reversed(host.split(".")) if host else iter(())
    while True:
        if node.paths is not None:
            best = longest_path(node.paths, path) or best
        node = node.children.get(next(labels, None))
        if node is None:
            return best


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL; both empty for null or without ``://``."""
    part = lambda k: F.coalesce(F.regexp_extract(url, "://([^/?#]*)([^?#]*)", k), F.lit(""))
    return ascii_lower(part(1)), part(2)


def judge_urls(df: DataFrame, rules: list[Rule], url: str = "url", default: str = "allow") -> DataFrame:
    """Adds host, path, rule (text of the winning rule or null) and verdict to df."""
    if len(rules) > MAX_RULES or any(r.path.count("/") > MAX_SEGMENTS or r.host.count(".") > MAX_SEGMENTS for r in rules):
        listed = df.sparkSession.createDataFrame([(r.host, r.path, r.verdict) for r in rules], "host string, path string, verdict string")
        return judge_by_join(df, listed, url, default)
    trie = df.sparkSession.sparkContext.broadcast(build_trie(rules))

    @F.pandas_udf("rule string, verdict string")
    def walk(parts: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        root = trie.value
        for hosts, paths in parts:
            won = [lookup(root, h, p) for h, p in zip(hosts, paths)]
            yield pd.DataFrame({"rule": [r and r.text for r in won], "verdict": [r.verdict if r else default for r in won]}, dtype=object)

    host, path = host_and_path(F.col(url))
    kept = [c for c in df.columns if c not in ("host", "path", "rule", "verdict")]
    out = df.select(*kept, host.alias("host"), path.alias("path"))
    return out.select(*kept, "host", "path", walk("host", "path").alias("rule")).select(*kept, "host", "path", "rule.rule", "rule.verdict")


def judge_by_join(df: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow") -> DataFrame:
    """judge_urls() for a table of rules (host, path, verdict) of any size: the trie's edges as join keys.  Each different
    (host, path) asks under all its host suffixes and leading runs of whole segments; a rule stands under its host and whole
    segments, and what its path has beyond them is compared after the join."""
    host, path = host_and_path(F.col(url))
    kept = [c for c in df.columns if c not in ("host", "path", "rule", "verdict")]
    out = df.select(*kept, host.alias("host"), path.alias("path"))
    whole = lambda p: F.regexp_extract(p, "^(.*/)?", 0)
    keyed = rules.select(F.col("host").alias("at"), whole(F.col("path")).alias("under"), F.col("path").alias("r_path"), "verdict").distinct()
    labels, parts = F.split("host", "[.]"), F.split("path", "/")
    above = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    leading = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.concat(F.array_join(F.slice(parts, 1, i - 1), "/"), F.when(i > 1, F.lit("/")).otherwise(F.lit(""))))
    asked = out.select("host", "path").distinct().select("host", "path", F.explode(F.array_distinct(F.array_append(above, F.lit("")))).alias("at"))
    asked = asked.select("host", "path", "at", F.explode(leading).alias("under"))
    depth = F.when(F.col("at") == "", 0).otherwise(F.size(F.split("at", "[.]")))
    fit = asked.join(keyed, ["at", "under"]).where(F.col("path").startswith(F.col("r_path")))
    best = fit.groupBy("host", "path").agg(F.max(F.struct(depth.alias("depth"), F.length("r_path").alias("n"), (F.col("verdict") == "block").alias("block"), F.concat("at", "r_path").alias("rule"), "verdict")).alias("won"))
    best = best.select(F.col("host").alias("_h"), F.col("path").alias("_p"), F.col("won.rule").alias("rule"), F.col("won.verdict").alias("verdict"))
    names = [f"_k{i}" for i in range(len(kept))]  # columns of any name pass through the join
    wide = out.toDF(*names, "host", "path").join(best, (F.col("host") == F.col("_h")) & (F.col("path") == F.col("_p")), "left")
    return wide.select(*[F.col(a).alias(b) for a, b in zip(names, kept)], "host", "path", "rule", F.coalesce("verdict", F.lit(default)).alias("verdict"))


RULES = [
    Rule("net", "/", "block"),
    Rule("example.net", "/en/", "allow"),
    Rule("example.com", "/de/", "block"),
    Rule("org", "/fr/", "allow"),
]


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(table(spark, sf_dir, "pages").select("page_id", "url"), RULES).drop("url")


ORACLE = """
WITH parts AS (
  SELECT page_id,
    coalesce(translate(regexp_extract(url, '://([^/?#]*)([^?#]*)', 1),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
    coalesce(regexp_extract(url, '://([^/?#]*)([^?#]*)', 2), '') AS path
  FROM pages),
rules(r_host, r_path, r_verdict) AS (
  VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
won AS (
  SELECT page_id, host, path, r_host || r_path AS rule, r_verdict,
    row_number() OVER (PARTITION BY page_id ORDER BY length(r_host) DESC NULLS LAST, length(r_path) DESC NULLS LAST) AS rn
  FROM parts LEFT JOIN rules ON (host = r_host OR ends_with(host, '.' || r_host)) AND starts_with(path, r_path))
SELECT page_id, host, path, rule, coalesce(r_verdict, 'allow') AS verdict FROM won WHERE rn = 1
"""
