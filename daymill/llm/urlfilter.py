"""URL filters over sorted digest arrays.

A list of rules (host, path, verdict) becomes a file with a sorted array of 64-bit xxhash digests of the rules'
strings ``host/path``, and the strings themselves. Tasks map the file into memory, probe the digests of what a url
could match (each of its host's suffixes with each rule length of its path's beginning) by vectorised binary search,
and confirm hits with the stored strings, so that colliding digests never decide. The longest rule that fits wins.

The file goes out with Spark's file distribution; it grows with the list, not with the table that is filtered, and a
list over ``MOST_BYTES`` is refused rather than sent.

A null url, or one without ``://``, has empty host and path and fits no rule. Every row gives a row.
"""

from __future__ import annotations

import os
import re
import tempfile
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._common import small_batches

MOST_BYTES = 256 << 20
ALLOW, BLOCK = "allow", "block"

#: The rules of the contract, as (host, path, verdict); the longest that fits wins.
RULES = (
    ("org", "/", ALLOW),
    ("example.org", "/es/", BLOCK),
    ("example.org", "/en/1", BLOCK),
    ("com", "/fr/", ALLOW),
    ("com", "/de/", BLOCK),
)
#: The method's own list where no rule fits: these hosts and their subdomains are blocked, all others allowed.
BLOCKED_HOSTS = (
    "ads-track.example.com",
    "adult-x.example.com",
    "casino-win.example.net",
    "cheap-pills.example.net",
    "free-bets.example.net",
    "spam-farm.example.org",
)


_DOT = re.compile(r"\.")


def _entry(host: str, path: str) -> bytes:
    return f"{host}\0{path}".encode("utf-8", "surrogatepass")


class Digests:
    """A file of entries in the order of their digests: keys, what each is, where its string is, strings."""

    def __init__(self, path: str) -> None:
        n, lengths, self.longest = np.fromfile(path, np.int64, 3).tolist()
        self.lengths = np.memmap(path, np.int64, "r", 24, (lengths,)).tolist()
        at = 24 + 8 * lengths
        self.keys = np.memmap(path, np.uint64, "r", at, (n,)) if n else np.zeros(0, np.uint64)
        self.ends = np.memmap(path, np.int64, "r", at + 8 * n, (n + 1,))
        self.kinds = np.memmap(path, np.uint8, "r", at + 16 * n + 8, (n,)) if n else np.zeros(0, np.uint8)
        self.strings = np.memmap(path, np.uint8, "r", at + 17 * n + 8) if n else np.zeros(0, np.uint8)

    @staticmethod
    def write(path: str, rules: Iterable[tuple[str, str, str]], blocked: Iterable[str]) -> None:
        """kinds: 0 and 1 are rules that allow and block, 2 is a host of the list."""
        entries = {_entry(h, p): (int(v == BLOCK), len(p)) for h, p, v in rules}
        for h in blocked:
            entries.setdefault(_entry(h, ""), (2, 0))
        rows = sorted((xxhash.xxh64_intdigest(k), k, kind) for k, (kind, _) in entries.items())
        if sum(len(k) + 17 for _, k, _ in rows) > MOST_BYTES:
            raise ValueError(f"the list is over {MOST_BYTES} bytes; split it")
        lengths = sorted({n for _, n in entries.values()})
        longest = max((len(k.decode("utf-8", "surrogatepass").split("\0", 1)[0]) for k in entries), default=0)
        with open(path, "wb") as f:
            np.array([len(rows), len(lengths), longest, *lengths], np.int64).tofile(f)
            np.array([r[0] for r in rows], np.uint64).tofile(f)
            np.cumsum([0, *(len(r[1]) for r in rows)], dtype=np.int64).tofile(f)
            np.array([r[2] for r in rows], np.uint8).tofile(f)
            f.write(b"".join(r[1] for r in rows))

    def find(self, strings: list[bytes]) -> np.ndarray:
        """The place of each string's entry, or -1."""
        digests = np.fromiter(map(xxhash.xxh64_intdigest, strings), np.uint64, len(strings))
        at = np.searchsorted(self.keys, digests)
        out = np.full(len(strings), -1)
        hit = np.flatnonzero(at < len(self.keys))
        hit = hit[self.keys[at[hit]] == digests[hit]]
        for i in hit:
            place = int(at[i])
            while place < len(self.keys) and self.keys[place] == digests[i]:  # entries whose digests collide stand together
                if self.strings[self.ends[place] : self.ends[place + 1]].tobytes() == strings[i]:
                    out[i] = place
                    break
                place += 1
        return out

    def judge_all(self, urls: list[tuple[str, str]]) -> list[tuple[str | None, str]]:
        """(rule, verdict) of each (host, path)."""
        strings, owners = [], []
        for i, (host, path) in enumerate(urls):
            # a suffix that is longer than every listed host can't be one, so long hosts cost no more than their end
            first = max(0, len(host) - self.longest)
            places = [m.end() for m in _DOT.finditer(host, first)]
            for k in [first, *places] if not first or host[first - 1] == "." else places:
                suffix = host[k:]
                for n in self.lengths:
                    if n <= len(path):
                        strings.append(_entry(suffix, path[:n]))
                        owners.append(i)
        best: dict[int, tuple[int, str, str]] = {}
        listed = set()
        for i, s, place in zip(owners, strings, self.find(strings).tolist(), strict=True):
            if place < 0:
                continue
            kind = int(self.kinds[place])
            if kind == 2:
                listed.add(i)
            else:
                rule = s.decode("utf-8", "surrogatepass").replace("\0", "", 1)
                best[i] = max(best.get(i, (-1, "", "")), (len(rule), rule, BLOCK if kind else ALLOW))
        return [best[i][1:] if i in best else (None, BLOCK if i in listed else ALLOW) for i in range(len(urls))]


def host_and_path(url: str) -> tuple[Column, Column]:
    """The host (A-Z lower-cased) and path of a column of urls."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    rest = F.when(F.instr(url, "://") > 0, F.expr(f"substring(`{url}`, instr(`{url}`, '://') + 3)")).otherwise("")
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)
    return F.translate(host, upper, upper.lower()), path


def judge(pages: DataFrame, rules: Iterable[tuple[str, str, str]] = RULES, blocked: Iterable[str] = BLOCKED_HOSTS, url_col: str = "url") -> DataFrame:
    """pages with __mill_host, __mill_path, __mill_rule and __mill_verdict: the longest rule that fits, else the list's verdict."""
    spark = pages.sparkSession
    small_batches(spark, rows=10_000)
    folder = tempfile.mkdtemp(prefix="spark-")
    handle, path = tempfile.mkstemp(suffix=".digests", dir=folder)
    os.close(handle)
    Digests.write(path, rules, blocked)
    spark.sparkContext.addFile(path)
    name = os.path.basename(path)

    @F.pandas_udf("rule string, verdict string")
    def verdicts(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        digests = Digests(SparkFiles.get(name))
        for hosts, paths in batches:
            yield pd.DataFrame(digests.judge_all(list(zip(hosts, paths, strict=True))), columns=["rule", "verdict"])

    host, path = host_and_path(url_col)
    own = [F.col(f"`{c}`") for c in pages.columns]
    step = pages.select(*own, host.alias("__mill_host"), path.alias("__mill_path"))
    step = step.select("*", verdicts("__mill_host", "__mill_path").alias("__mill_judged"))
    return step.select(*own, "__mill_host", "__mill_path", F.col("__mill_judged.rule").alias("__mill_rule"), F.col("__mill_judged.verdict").alias("__mill_verdict"))


def allowed(pages: DataFrame, **how) -> DataFrame:
    """The pages whose urls are allowed."""
    return judge(pages, **how).filter(F.col("__mill_verdict") == ALLOW).select(*[F.col(f"`{c}`") for c in pages.columns])
