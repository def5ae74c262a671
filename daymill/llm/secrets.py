"""Secret scans over a trigram inverted index.

Each rule's regular expression gives a Boolean trigram query: clauses, all of which must hold, each with alternatives
that are sets of lower-case trigrams (rules are matched in either case here, so this only lets more through). The
index holds postings (trigram, document) for the trigrams that some rule asks for. Postings are intersected by rule;
only documents that satisfy a rule's query are read again and matched by it. Rules without a mandatory trigram scan
every text.

DataFrame functions only. A null text is empty; rows are known by id and text together, so repeated rows and null or
repeated ids each get their own result. Other columns of the input are not touched.
"""

from __future__ import annotations

import re
from collections.abc import Iterable
from re import _constants as C
from re import _parser

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import _spans
from ._common import materialise, text_or_empty

#: The base rules. A match counts if its length, or that of its group, reaches the least.
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
BASE = {
    "assign": ASSIGN,
    "access": r"AKIA[A-Z0-9]{16,}",
    "hex": r"[0-9a-f]{24,}",
}
#: Rules of the method's own.
MORE = {
    "private_key": r"-----BEGIN [A-Z ]{0,30}PRIVATE KEY-----",
    "code_host": r"gh[pousr]_[A-Za-z0-9]{36,}",
    "chat": r"xox[abprs]-[A-Za-z0-9-]{10,}",
    "cloud_key": r"AIza[A-Za-z0-9_-]{35}",
    "payment": r"[sr]k_live_[A-Za-z0-9]{16,}",
    # starts where a run of its characters does, and gives nothing back: time stays linear in repeated beginnings
    "web_token": r"(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]{10,}+\.eyJ[A-Za-z0-9_-]{10,}+\.[A-Za-z0-9_-]{10,}+",
    "url_login": r"://[A-Za-z0-9._-]{1,64}:[^\s/:@]{3,128}@",
}
RULES = BASE | MORE
LEAST_ASSIGNED = 6
#: Above so many, a set of strings is no longer spelled out.
MOST_STRINGS = 64

Clause = frozenset[frozenset[str]]


def _trigrams(s: str) -> frozenset[str]:
    return frozenset(s[i : i + 3] for i in range(len(s) - 2))


def _clauses_of(strings: set[str]) -> list[Clause]:
    return [frozenset(map(_trigrams, strings))] if strings and all(len(s) >= 3 for s in strings) else []


def _strings(node: tuple) -> set[str] | None:
    """All strings that a node of the parsed expression matches, lower-cased, or None if they are too many."""
    op, value = node
    if op is C.LITERAL:
        return {chr(value).lower()}
    if op is C.IN:
        chars = set()
        for kind, x in value:
            if kind is C.LITERAL:
                chars.add(chr(x).lower())
            elif kind is C.RANGE and x[1] - x[0] < 4:
                chars |= {chr(c).lower() for c in range(x[0], x[1] + 1)}
            else:
                return None
        return chars if len(chars) <= 8 else None
    if op is C.SUBPATTERN:
        return _sequence_strings(value[3])
    if op is C.BRANCH:
        parts = [_sequence_strings(x) for x in value[1]]
        return None if None in parts else set().union(*parts)
    if op in (C.MAX_REPEAT, C.MIN_REPEAT) and value[1] is not C.MAXREPEAT and value[1] <= 2:
        own = _sequence_strings(value[2])
        if own is not None:
            return {s for n in range(value[0], value[1] + 1) for s in _power(own, n)}
    if op is C.AT:
        return {""}
    return None


def _power(strings: set[str], n: int) -> set[str]:
    out = {""}
    for _ in range(n):
        out = {a + b for a in out for b in strings}
    return out


def _sequence_strings(nodes: Iterable[tuple]) -> set[str] | None:
    out = {""}
    for node in nodes:
        own = _strings(node)
        if own is None or len(out) * len(own) > MOST_STRINGS:
            return None
        out = {a + b for a in out for b in own}
    return out


def trigram_query(pattern: str) -> list[Clause]:
    """The clauses that every match satisfies; an empty list if no trigram is mandatory."""
    clauses: list[Clause] = []

    def visit(nodes: Iterable[tuple]) -> None:
        run: set[str] = {""}
        for node in nodes:
            own = _strings(node)
            if own is not None and len(run) * len(own) <= MOST_STRINGS:
                run = {a + b for a in run for b in own}
                continue
            clauses.extend(_clauses_of(run))
            run = own if own is not None else {""}
            if own is None:
                op, value = node
                if op is C.SUBPATTERN:
                    visit(value[3])
                elif op in (C.MAX_REPEAT, C.MIN_REPEAT) and value[0] >= 1:
                    visit(value[2])
        clauses.extend(_clauses_of(run))

    visit(_parser.parse(pattern))
    return list(dict.fromkeys(frozenset(a for a in c if not any(b < a for b in c)) for c in clauses))


def index(docs: DataFrame, trigrams: list[str]) -> DataFrame:
    """Postings (trigram, key) of the given trigrams; docs has key and text."""
    lowered = docs.select("key", F.lower("text").alias("low"))
    present = F.array_compact(F.array(*[F.when(F.col("low").contains(t), F.lit(t)) for t in trigrams]))
    return lowered.select(F.explode(present).alias("trigram"), "key")


def candidates(postings: DataFrame, queries: dict[str, list[Clause]]) -> DataFrame:
    """(key, rules): which rules' queries each document satisfies, by intersecting postings."""
    trigrams = sorted({t for clauses in queries.values() for c in clauses for a in c for t in a})
    place = F.array_position(F.array(*map(F.lit, trigrams)), F.col("trigram")) - 1
    # Bit i of the sets (62 trigrams a word) says that the document is in the postings of trigram i.
    words = range(0, len(trigrams), 62)
    sets = postings.withColumn("i", place).groupBy("key").agg(
        *[F.bit_or(F.when((F.col("i") >= w) & (F.col("i") < w + 62), F.expr(f"shiftleft(1L, cast(i - {w} AS int))")).otherwise(F.lit(0).cast("long"))).alias(f"w{w}") for w in words]
    )

    def holds(alternative: frozenset[str]) -> Column:
        out = F.lit(True)
        for w in words:
            mask = sum(1 << (trigrams.index(t) - w) for t in alternative if w <= trigrams.index(t) < w + 62)
            out = out & (F.col(f"w{w}").bitwiseAND(F.lit(mask).cast("long")) == mask) if mask else out
        return out

    def satisfied(clauses: list[Clause]) -> Column:
        out = F.lit(True)
        for clause in clauses:
            some = F.lit(False)
            for alternative in clause:
                some = some | holds(alternative)
            out = out & some
        return out

    rules = F.array_compact(F.array(*[F.when(satisfied(clauses), F.lit(rule)) for rule, clauses in queries.items()]))
    return sets.select("key", rules.alias("rules")).filter(F.size("rules") > 0)


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: dict[str, str] | None = None) -> DataFrame:
    """docs with __mill_found: each row's matches as structs (at, place, until, kind), in code points, until exclusive.

    place is the kind's place among the rules. rules: patterns by kind, the base rules and the method's by default.
    """
    rules = rules or RULES
    for pattern in rules.values():
        re.compile(pattern)
    queries = {kind: trigram_query(pattern) for kind, pattern in rules.items()}
    indexed = {kind: q for kind, q in queries.items() if q}
    keyed = docs.withColumn("__mill_text", text_or_empty(text_col)).withColumn("__mill_key", F.xxhash64(id_col, "__mill_text"))
    trigrams = sorted({t for clauses in indexed.values() for c in clauses for a in c for t in a})
    if indexed:
        postings = index(keyed.select(F.col("__mill_key").alias("key"), F.col("__mill_text").alias("text")), trigrams)
        found = materialise(candidates(postings, indexed), "secret-candidates")
        keyed = keyed.join(found.select(F.col("key").alias("__mill_key"), F.col("rules").alias("__mill_rules")), "__mill_key", "left")
    else:
        keyed = keyed.withColumn("__mill_rules", F.lit(None).cast("array<string>"))
    none = F.expr("cast(array() AS array<string>)")
    asked = {kind: F.lit(True) if kind not in indexed else F.coalesce(F.array_contains("__mill_rules", kind), F.lit(False)) for kind in rules}
    own = [F.col(f"`{c}`") for c in docs.columns]
    text = F.col("__mill_text")
    step = keyed.select(*own, text, *[F.when(asked[k], _spans.hits("__mill_text", p)).otherwise(none).alias(f"__mill_hits_{k}") for k, p in rules.items()])
    step = step.select(*own, *[_spans.placed("__mill_text", p, f"__mill_hits_{k}").alias(f"__mill_at_{k}") for k, p in rules.items()])

    def kept(kind: str) -> Column:
        found = F.col(f"__mill_at_{kind}")
        if rules[kind] == ASSIGN:
            found = F.filter(found, lambda m: F.length(F.regexp_extract(m["hit"], ASSIGN, 2)) >= LEAST_ASSIGNED)
        place = list(rules).index(kind)
        return F.transform(found, lambda m: F.struct(m["at"].alias("at"), F.lit(place).alias("place"), m["until"].alias("until"), F.lit(kind).alias("kind")))

    return step.select(*own, F.concat(*map(kept, rules)).alias("__mill_found"))


def report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans) of every row."""
    found = scan(docs.select(id_col, text_col), id_col, text_col)
    counts = [_spans.count_if("__mill_found", k).alias(f"n_{k}") for k in BASE]
    base = _spans.listed(F.filter("__mill_found", lambda s: s["place"] < len(BASE)))
    return found.select(F.col(id_col).alias("doc_id"), *counts, F.sha2(base, 256).alias("base_sha256"), _spans.listed(F.col("__mill_found")).alias("spans"))


def redact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with <kind> in place of each secret in the texts; overlapping secrets become one, named by the first.

    All rows and all other columns stay as they are; texts without a secret do too, null ones included.
    """
    found = scan(docs, id_col, text_col)
    return found.withColumn(text_col, _spans.replaced(text_col, "__mill_found")).drop("__mill_found")
