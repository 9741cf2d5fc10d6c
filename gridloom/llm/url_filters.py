"""URL filters: allow and block rules in a trie over reversed host labels and path segments, the longest fitting rule decides."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.llm.common import LOWER, UPPER, Sent, table

#: Characters of all rules up to which the trie is sent to the tasks, where it takes about 45 bytes for each (90 MB); longer lists are joined.
MAX_TRIE_CHARS = 2_000_000

#: The rules of the query, as (host, path, verdict).
QUERY_RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case; '' without one."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def url_path(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; '' without ``://``."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def normal_rules(rules: Iterable[tuple[str | None, str | None, str]]) -> list[tuple[str, str, str]]:
    """Rules with host and path, verdicts in lower case, each (host, path) once: of two verdicts block decides."""
    known: dict[tuple[str, str], str] = {}
    for host, path, verdict in rules:
        if host is not None and path is not None:
            known[host, path] = max(verdict.lower(), known.get((host, path), ""))
    return [(host, path, verdict) for (host, path), verdict in known.items()]


class HostNode:
    """Child labels, and the root of the paths of the rules for this host."""

    __slots__ = ("labels", "paths")

    def __init__(self):
        self.labels: dict[str, HostNode] = {}
        self.paths: PathNode | None = None


class PathNode:
    """Child segments, and the rules that end in the middle of the next segment, by that beginning."""

    __slots__ = ("segments", "ends")

    def __init__(self):
        self.segments: dict[str, PathNode] = {}
        self.ends: dict[str, tuple[str, str]] = {}


class RuleTrie:
    """Host labels from the right, then path segments."""

    def __init__(self, rules: Iterable[tuple[str, str, str]]):
        self.root = HostNode()
        for host, path, verdict in normal_rules(rules):
            node = self.root
            for label in reversed(host.split(".")):
                node = node.labels.setdefault(label, HostNode())
            if node.paths is None:
                node.paths = PathNode()
            *segments, tail = path.split("/")
            at = node.paths
            for segment in segments:
                at = at.segments.setdefault(segment, PathNode())
            at.ends[tail] = (host + path, verdict)

    def fit(self, host: str, path: str) -> tuple[str, str] | None:
        """The rule with the most characters that fits, as (rule, verdict); of equally long ones a block, of these the last by name."""
        best, node, segments = None, self.root, path.split("/")
        for label in reversed(host.split(".")):
            node = node.labels.get(label)
            if node is None:
                break
            at = node.paths
            for segment in segments:
                if at is None:
                    break
                for tail, (rule, verdict) in at.ends.items():
                    if segment.startswith(tail) and (best is None or (len(rule), verdict, rule) > (len(best[0]), best[1], best[0])):
                        best = rule, verdict
                at = at.segments.get(segment)
        return best


def judge(pages: DataFrame, rules: Iterable[tuple[str, str, str]], default: str = "allow") -> DataFrame:
    """``page_id, host, path, rule, verdict``, one row per page.

    ``rules`` are (host, path, 'allow' | 'block'). A rule fits its host and every
    subdomain if the path starts with the rule's path. The rule with the most characters
    decides, of equally long ones a block, of these the last by name; without a rule the verdict is ``default``.
    Rules without host or path are left out, and verdicts may be in any case.
    Lists of more than ``MAX_TRIE_CHARS`` characters go to :func:`judge_joined`.

    Null urls and urls without ``://`` have an empty host and path, which no rule fits.
    Repeated rows and null ids stay as they are, other columns are left out. No rows: no rows.
    """
    rules = normal_rules(rules)
    if sum(len(host) + len(path) for host, path, _ in rules) > MAX_TRIE_CHARS:
        spark = pages.sparkSession
        return judge_joined(pages, spark.createDataFrame(rules, "host string, path string, verdict string"), default)
    trie = Sent(pages.sparkSession, RuleTrie(rules))

    @F.pandas_udf("rule string, verdict string")
    def fitted(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for hosts, paths in batches:
            yield pd.DataFrame([trie.value.fit(h, p) or (None, default) for h, p in zip(hosts, paths)], columns=["rule", "verdict"], dtype=object)

    parsed = pages.select("page_id", url_host(F.col("url")).alias("host"), url_path(F.col("url")).alias("path"))
    return parsed.withColumn("r", fitted("host", "path")).select("page_id", "host", "path", "r.rule", "r.verdict")


def judge_joined(pages: DataFrame, rules: DataFrame, default: str = "allow") -> DataFrame:
    """The same result for rule tables of any size: each page's host suffixes and path prefixes meet the rules by key.

    Prefixes are cut only at lengths that some rule has; distinct (host, path) pairs are judged once.
    """
    rules = rules.select("host", "path", F.lower("verdict").alias("verdict")).where(F.col("host").isNotNull() & F.col("path").isNotNull())
    rules = rules.groupBy("host", "path").agg(F.max("verdict").alias("v"))
    lengths = [row[0] for row in rules.select(F.length("path").alias("n")).distinct().orderBy("n").collect()]  # at most as many as the longest path has characters
    parsed = pages.select("page_id", url_host(F.col("url")).alias("host"), url_path(F.col("url")).alias("path"))
    distinct = parsed.select("host", "path").distinct()
    labels = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels) - i + 1), "."))
    cuts = F.filter(F.lit(lengths) if lengths else F.array().cast("array<int>"), lambda n: n <= F.length("path"))
    keys = distinct.select("host", "path", F.explode(suffixes).alias("s")).select("host", "path", "s", F.explode(cuts).alias("n"))
    keys = keys.select("host", "path", "s", F.substring(F.col("path"), F.lit(1), F.col("n")).alias("p"))
    met = keys.join(rules.select(F.col("host").alias("s"), F.col("path").alias("p"), "v"), ["s", "p"])
    best = met.groupBy("host", "path").agg(F.max(F.struct((F.length("s") + F.length("p")).alias("n"), F.col("v"), F.concat("s", "p").alias("rule"))).alias("b"))
    return parsed.join(best, ["host", "path"], "left").select(
        "page_id", "host", "path", F.col("b.rule").alias("rule"), F.coalesce(F.col("b.v"), F.lit(default)).alias("verdict")
    )


def op3_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "pages"), QUERY_RULES)


OP3_SQL = r"""
WITH parsed AS (
  SELECT page_id, translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages
), rules(rule_host, rule_path, v) AS (
  VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')
), best AS (
  SELECT host, path, max_by(struct_pack(rule := rule_host || rule_path, v := v), length(rule_host || rule_path)) AS b
  FROM (SELECT DISTINCT host, path FROM parsed) p JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
  GROUP BY host, path
)
SELECT page_id, p.host, p.path, b.rule AS rule, coalesce(b.v, 'allow') AS verdict FROM parsed p LEFT JOIN best USING (host, path)
"""
