"""URL rules by a sort-merge range join over reversed hosts.

``www.example.com`` has the canonical key ``com.example.www.``; what a rule's host and its
subdomains share is a prefix of the key, so an interval in sort order, and intervals are
nested or apart. Keys (with path and id, so that one host may span many partitions) are
dealt out in ranges; each rule goes to the ranges that its interval touches. A sweep of a
sorted range then keeps the stack of rules whose interval holds the present key. The paths of a host's rules are
nested intervals in the same way: sorted, each with a link to the longest that it begins with, so a url's path is found
by bisection and at most as many links as rules are nested.
"""

from __future__ import annotations

import string
from bisect import bisect_left, bisect_right
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import partitions

#: keys that the driver gets to choose range bounds from, for each range, and how much of each
SAMPLED = 64
BOUND_CHARS = 512
RULES = (("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"), ("net", "/fr/", "block"))


def parsed(pages: DataFrame, url: str = "url") -> DataFrame:
    """Add host and path: '' for both where the url is null or has no ``://``."""
    rest = F.when(F.instr(url, "://") > 0, F.expr(f"substring({url}, instr({url}, '://') + 3)"))
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), string.ascii_uppercase, string.ascii_lowercase)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return pages.withColumns({"host": F.coalesce(host, F.lit("")), "path": F.coalesce(path, F.lit(""))})


def key_of(host: str = "host"):
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.", -1)), "."), F.lit("."))


def _place(bounds: list[str]):
    """Ranges of rows (a row for each that a rule touches): from place(key) to place(key's end)."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.schema.names[0] == "is_rule":
                at, ranges = [], []
                for i, k in enumerate(batch.column(1).to_pylist()):
                    # what starts with k sorts from k to k with its last sign raised
                    first, last = bisect_right(bounds, k), bisect_left(bounds, k[:-1] + chr(ord(k[-1]) + 1))
                    ranges += range(first, last + 1)
                    at += [i] * (last + 1 - first)
                batch = batch.take(pa.array(at, pa.int64()))
            else:
                whole = zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True)
                ranges = [bisect_right(bounds, f"{k}\0{p}\0{i}") for k, p, i in whole]
            yield pa.RecordBatch.from_arrays([pa.array(ranges, pa.int32()), *batch.columns], ["range", *batch.schema.names])

    return run


class Paths:
    """The path rules of one host, of which the longest that a path begins with is wanted."""

    def __init__(self):
        self.rules: dict[str, tuple[str, str]] = {}
        self.order: list[str] | None = None

    def add(self, path: str, rule: str, verdict: str) -> None:
        self.rules.setdefault(path, (rule, verdict))
        self.order = None

    def find(self, path: str) -> tuple[str, str] | None:
        if self.order is None:
            self.order, self.within, stack = sorted(self.rules), [], []
            for i, p in enumerate(self.order):
                while stack and not p.startswith(self.order[stack[-1]]):
                    stack.pop()
                self.within.append(stack[-1] if stack else -1)
                stack.append(i)
        # what path begins with is the last one sorted before it, or what that one begins with
        at = bisect_right(self.order, path) - 1
        while at >= 0 and not path.startswith(self.order[at]):
            at = self.within[at]
        return self.rules[self.order[at]] if at >= 0 else None


def _sweep(default: str):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, stack = None, []  # of (key, its paths), each key a prefix of the next
        for batch in batches:
            rules, verdicts = [], []
            named = zip(*(batch.column(i).to_pylist() for i in range(6)), strict=True)
            keep = []
            for r, (place, is_rule, key, path, rule, verdict) in enumerate(named):
                if place != now:
                    now, stack = place, []
                while stack and not key.startswith(stack[-1][0]):
                    stack.pop()
                if is_rule:
                    if not stack or stack[-1][0] != key:
                        stack.append((key, Paths()))
                    stack[-1][1].add(path, rule, verdict)
                    continue
                found = next((f for _, paths in reversed(stack) if (f := paths.find(path))), (None, default))
                keep.append(r)
                rules.append(found[0])
                verdicts.append(found[1])
            rows = batch.take(pa.array(keep, pa.int64()))
            yield pa.RecordBatch.from_arrays([rows.column(6), rows.column(7), rows.column(3), pa.array(rules, pa.string()), pa.array(verdicts, pa.string())], ["page_id", "host", "path", "rule", "verdict"])

    return run


def judge(pages: DataFrame, rules: DataFrame, default: str = "allow") -> DataFrame:
    """(page_id, host, path, rule, verdict) for each page; rules has host, path, verdict.

    A rule fits its host and subdomains where the url's path starts with its own. The longest
    host wins, then the longest path, then the smaller verdict (of rules stated twice). Where none fits, rule is
    null and verdict is ``default``. Null rule paths count as empty, rules without a host
    are left out; a null or unparsable url has an empty host and path. Every row gives one,
    repeated rows too; other columns are ignored. No pages: an empty result.
    """
    spark = pages.sparkSession
    urls = parsed(pages.select(F.col("page_id").cast("long"), F.col("url").cast("string")))
    keyed = urls.select(key_of().alias("key"), "path", F.coalesce("page_id", F.lit(-1)).alias("tie"), "page_id", "host")
    n = partitions(spark) * 8
    total = keyed.count()
    share = min(1.0, SAMPLED * n / max(total, 1))
    # a bounded sample by hash, alike in each run, only to place the bounds of the ranges
    picked = keyed.where(F.pmod(F.xxhash64("key", "path", "tie"), F.lit(1 << 30)) < int(share * (1 << 30)))
    whole = sorted(r[0] for r in picked.select(F.substring(F.concat_ws("\0", "key", "path", F.col("tie").cast("string")), 1, BOUND_CHARS)).collect())
    bounds = sorted({whole[i * len(whole) // n] for i in range(1, n)}) if whole else []
    places = keyed.mapInArrow(_place(bounds), "range int, key string, path string, tie long, page_id long, host string")
    named = rules.where("host is not null and host <> ''").select(F.lit(True).alias("is_rule"), key_of("host").alias("key"), F.coalesce("path", F.lit("")).alias("path"), F.concat(F.col("host"), F.coalesce("path", F.lit(""))).alias("rule"), "verdict")
    ruled = named.mapInArrow(_place(bounds), "range int, is_rule boolean, key string, path string, rule string, verdict string")
    none = F.lit(None)
    both = ruled.select("range", "is_rule", "key", "path", "rule", "verdict", none.cast("long").alias("page_id"), none.cast("string").alias("host")).unionByName(
        places.select("range", F.lit(False).alias("is_rule"), "key", "path", none.cast("string").alias("rule"), none.cast("string").alias("verdict"), "page_id", "host")
    )
    # a rule sorts before the urls of its own key
    dealt = both.repartition(n // 8, "range").sortWithinPartitions("range", "key", F.desc("is_rule"), "path", "verdict", "page_id")
    return dealt.mapInArrow(_sweep(default), "page_id long, host string, path string, rule string, verdict string")
