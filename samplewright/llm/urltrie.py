"""URL filters: allow and block rules in a trie over reversed host labels, then path segments.

A rule is (host, path, verdict). It fits its host and all subdomains, if the url's path
starts with the rule's path. The longest fit wins: more host labels first, then the
longer path; of equal rules, block wins, then the rule's text that is first by code point.
"""

from __future__ import annotations

from collections.abc import Iterable

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Rules up to this number and of so many bytes are broadcast, as a trie of 200 MB at most; more are joined.
BROADCAST_RULES = 100_000
BROADCAST_BYTES = 8 << 20
RESULT = "struct<host:string,path:string,rule:string,verdict:string>"
_UPPER_LETTERS, _LOWER_LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_LOWER = str.maketrans(_UPPER_LETTERS, _LOWER_LETTERS)


def split_url(url: str | None) -> tuple[str, str]:
    """Host (A-Z lower-cased) and path; both empty for null and where there is no `://`."""
    _, sign, rest = (url or "").partition("://")
    if not sign:
        return "", ""
    rest = rest.partition("#")[0].partition("?")[0]
    host, slash, path = rest.partition("/")
    return host.translate(_LOWER), slash + path


class UrlTrie:
    """`hosts`: label -> node, from the last label; `paths`: segment -> node; `ends`: rules that end here.

    A rule's path is cut at `/`; all but its last piece must equal the url's segments and
    the last must be a prefix of the next one (always so for a path that ends with `/`).
    """

    __slots__ = ("ends", "hosts", "longest", "paths")

    def __init__(self) -> None:
        self.hosts: dict[str, UrlTrie] = {}
        self.paths: dict[str, UrlTrie] = {}
        self.ends: dict[str, tuple[str, str]] = {}
        #: characters of the longest of `ends`, the most that a segment is probed with
        self.longest = 0

    @classmethod
    def of(cls, rules: Iterable[tuple[str, str, str]]) -> UrlTrie:
        root = cls()
        for host, path, verdict in sorted(rules, key=lambda r: (r[2] != "block", r[0] + r[1])):
            node = root
            for label in reversed(host.translate(_LOWER).split(".")):
                node = node.hosts.setdefault(label, cls())
            *pieces, last = path.split("/")
            for piece in pieces:
                node = node.paths.setdefault(piece, cls())
            node.ends.setdefault(last, (host + path, verdict))
            node.longest = max(node.longest, len(last))
        return root

    def _in_path(self, segments: list[str]) -> tuple[str, str] | None:
        node, found = self, None
        for segment in segments:
            if node.ends:
                for length in range(min(len(segment), node.longest), -1, -1):
                    end = node.ends.get(segment[:length])
                    if end is not None:
                        found = end
                        break
            node = node.paths.get(segment)
            if node is None:
                break
        return found

    def match(self, host: str, path: str) -> tuple[str, str] | None:
        """(rule, verdict) of the longest fit, or None."""
        if not host:
            return None
        segments, node, found = path.split("/"), self, None
        for label in reversed(host.split(".")):
            node = node.hosts.get(label)
            if node is None:
                break
            if node.ends or node.paths:
                found = node._in_path(segments) or found
        return found


def judge_by_trie(df: DataFrame, rules: list[tuple[str, str, str]], url: str, default: str, into: str) -> DataFrame:
    """`df` with the struct column `into`; only the url goes to Python, in Arrow batches."""
    shared = df.sparkSession.sparkContext.broadcast(UrlTrie.of(rules))

    @F.pandas_udf(RESULT)
    def judged(urls: pd.Series) -> pd.DataFrame:
        trie, rows = shared.value, []
        for one in urls:
            host, path = split_url(one)
            rule, verdict = trie.match(host, path) or (None, default)
            rows.append((host, path, rule, verdict))
        return pd.DataFrame(rows, columns=["host", "path", "rule", "verdict"])

    return df.withColumn(into, judged(F.col(url)))


def judge_by_join(df: DataFrame, rules: DataFrame, url: str, key: str, default: str) -> DataFrame:
    """The same for any number of rules: one row (key, host, path, rule, verdict) for each row of `df`.

    A url's host suffixes, at most one for each label, meet the rules by equality, and the
    longest fit of each url is kept. Equal rows are judged once and stand for each other.
    """
    rest = F.regexp_extract(F.coalesce(F.col("_url"), F.lit("")), r"(?s)^.*?://([^?#]*)", 1)
    parts = df.select(F.col(key), F.col(url).alias("_url")).distinct().withColumn("_rest", F.when(F.col("_url").isNotNull(), rest).otherwise(""))
    parts = parts.withColumn("host", F.translate(F.regexp_extract("_rest", r"(?s)^([^/]*)", 1), _UPPER_LETTERS, _LOWER_LETTERS)).withColumn("path", F.regexp_extract("_rest", r"(?s)^[^/]*(.*)$", 1)).drop("_rest")
    labels = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    asked = parts.withColumn("_suffix", F.explode(suffixes))
    known = rules.select(F.translate("host", _UPPER_LETTERS, _LOWER_LETTERS).alias("_suffix"), F.col("path").alias("_path"), F.concat("host", "path").alias("rule"), F.col("verdict").alias("_verdict"))
    fits = asked.join(known, "_suffix").where(F.col("host") != "").where(F.startswith("path", F.col("_path")))
    best = Window.partitionBy(key, "_url").orderBy(F.length("_suffix").desc(), F.length("_path").desc(), F.col("_verdict").desc(), "rule")
    chosen = fits.withColumn("_n", F.row_number().over(best)).where("_n = 1").select(F.col(key).alias("_key"), F.col("_url").alias("_of"), "rule", "_verdict")
    same = F.col(key).eqNullSafe(F.col("_key")) & F.col("_url").eqNullSafe(F.col("_of"))
    one = parts.join(chosen, same, "left").select(F.col(key).alias("_k"), F.col("_url").alias("_u"), "host", "path", "rule", F.coalesce("_verdict", F.lit(default)).alias("verdict"))
    rows = df.select(F.col(key), F.col(url).alias("_url"))
    return rows.join(one, F.col(key).eqNullSafe(F.col("_k")) & F.col("_url").eqNullSafe(F.col("_u")), "left").select(key, "host", "path", "rule", "verdict")


def judge_urls(df: DataFrame, rules: DataFrame, url: str = "url", key: str = "page_id", default: str = "allow", broadcast_rules: int = BROADCAST_RULES) -> DataFrame:
    """(key, host, path, rule, verdict) for each row of `df`, repeated rows included.

    `rules`: host, path (empty or from `/`), verdict (`allow` or `block`); their hosts are
    A-Z lower-cased too. A rule with a null in any of these fits nothing. Null and empty
    urls and urls without `://` have an empty host and path, fit no rule and get the
    default. Urls are read whole, whatever their length. Other columns aren't read; an
    empty table gives no rows, and without rules all get the default. Rules are counted
    and measured: up to `broadcast_rules` of BROADCAST_BYTES are broadcast as a trie; more
    are joined, with the same result.
    """
    known = rules.select("host", "path", "verdict").dropna()
    size = known.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("host") + F.octet_length("path")), F.lit(0))).first()
    if size[0] > broadcast_rules or size[1] > BROADCAST_BYTES:
        return judge_by_join(df, known, url, key, default)
    few = [tuple(r) for r in known.collect()]
    return judge_by_trie(df.select(F.col(key), F.col(url)), few, url, default, "_judged").select(key, "_judged.*")
