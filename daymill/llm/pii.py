"""Personal data by weak supervision.

Candidates are the matches of broad expressions for e-mail addresses, IP addresses, card numbers, telephone numbers
with a country code, and other numbers. Labelers vote on each (for, against, or not at all): the kind's strict
expression, a checksum or range, a gazetteer of words before the candidate, and the context around it. Expectation-
maximisation over the table of vote patterns estimates each labeler's reliability and each pattern's probability; a
logistic span classifier is trained on these probabilities and decides. Base spans (that pass their kind's rule) stay
whatever it says; it adds further spans.

What is gathered are counts of vote patterns over all candidates of the corpus: at most 3 ** 4 patterns a kind,
whatever the input, and these alone reach the driver. DataFrame functions only. A null text is empty; every row gives
a row; other columns of the input are not touched.
"""

from __future__ import annotations

import functools
import math
from collections import defaultdict

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import _spans
from ._common import materialise, text_or_empty

#: The base kinds' expressions. Possessive quantifiers and the look-behinds (a match may start after
#: the last one's end, or where its first run of characters starts) only save time.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[ -]?[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
#: Numbers without a country code, in two to four groups.
NUMBER = r"(?<![0-9A-Za-z+.-])\(?[0-9]{2,4}\)?(?:[ .-][0-9]{2,4}){1,3}+(?![0-9A-Za-z-])"
KINDS = {**BASE, "number": NUMBER}

#: Words that go before personal data, in the languages of common corpora.
GAZETTEER = r"(?i)(?:phone|tel|telephone|call|mobile|cell|fax|contact|ssn|social security|passport|account|iban|card|visa|ip|address|e-?mail|mail|telefon|handy|konto|karte|adresse|téléphone|portable|compte|carte|teléfono|móvil|cuenta|tarjeta|correo)\W{0,3}(?:\w{1,8}\W{1,3})?$"
OCTET = r"0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"
STRICT = {
    "email": r"^[A-Za-z0-9][A-Za-z0-9._%+-]*@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,24}$",
    "ip": r"^(?:[1-9][0-9]{0,2})(?:\.[0-9]{1,3}){3}$",
    "card": r"^(?:[0-9]{13,19}|[0-9]{4}(?:[ -][0-9]{4}){3}|[0-9]{4}[ -][0-9]{6}[ -][0-9]{5})$",
    "phone": r"^\+[0-9]{1,3}(?:[ .-]?\(?[0-9]{1,4}\)?){2,5}$",
    "number": r"^(?:\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}|[0-9]{3}-[0-9]{2}-[0-9]{4}|[0-9]{2,3}(?:[ .][0-9]{2,4}){3})$",
}
VOTES = ("strict", "check", "words", "around")
BEFORE, AFTER = 40, 12


def _digits(s: Column) -> Column:
    return F.regexp_replace(s, "[^0-9]", "")


def _luhn(s: Column) -> Column:
    """Whether a string's digits pass the Luhn check."""
    digits = F.split(F.reverse(_digits(s)), "")
    doubled = F.transform(digits, lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise((d.cast("int") * 2) % 10 + F.floor(d.cast("int") / 5).cast("int")))
    return F.aggregate(doubled, F.lit(0), lambda a, x: a + F.coalesce(x, F.lit(0))) % 10 == 0


def _passes(kind: str, s: Column) -> Column:
    """The base rule of a kind on its expression's match."""
    n = F.length(_digits(s))
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        return s.rlike(rf"^{OCTET}\.{OCTET}\.{OCTET}\.{OCTET}$")
    if kind == "card":
        return F.when(n.between(12, 19), _luhn(s)).otherwise(F.lit(False))
    if kind == "phone":
        return n.between(9, 15)
    return F.lit(False)


def _vote(for_: Column, against: Column) -> Column:
    return F.when(for_, 1).when(against, -1).otherwise(0)


def candidates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, found): each row's candidates as structs (at, place, until, kind, base, votes)."""
    named = docs.select(F.col(id_col).alias("doc_id"), text_or_empty(text_col).alias("text"))
    step = named.select("doc_id", "text", *[_spans.hits("text", p).alias(f"hits_{k}") for k, p in KINDS.items()])
    some = functools.reduce(Column.__or__, [F.size(f"hits_{k}") > 0 for k in KINDS])
    cut = F.when(some, _spans.pieces("text")).alias("pieces")
    step = step.select("doc_id", cut, *[_spans.placed("text", p, f"hits_{k}").alias(f"at_{k}") for k, p in KINDS.items()])

    def judged(kind: str) -> Column:
        def one(m: Column) -> Column:
            hit = m["hit"]
            start = F.greatest(m["at"] - BEFORE, F.lit(0))
            before = _spans.part("pieces", start, m["at"] - start)
            after = _spans.part("pieces", m["until"], F.lit(AFTER))
            n = F.length(_digits(hit))
            check = {
                "email": _vote(F.length(hit) <= 254, F.length(hit) > 254),
                "ip": _vote(_passes("ip", hit), ~_passes("ip", hit)),
                "card": _vote(_passes("card", hit), n < 12),
                "phone": _vote(_passes("phone", hit), ~_passes("phone", hit)),
                "number": _vote(n.between(9, 11), (n < 7) | (n > 12)),
            }[kind]
            votes = F.struct(
                _vote(hit.rlike(STRICT[kind]), ~hit.rlike(STRICT[kind])).alias("strict"),
                check.alias("check"),
                _vote(before.rlike(GAZETTEER), F.lit(False)).alias("words"),
                _vote(before.rlike(r"[:<(]\s*$"), before.rlike(r"[\w$€£%#/=.-]$") | after.rlike(r"^(?:\w|%|[.,:/=-]\w)")).alias("around"),
            )
            base = F.lit(False) if kind == "number" else _passes(kind, hit)
            place = list(KINDS).index(kind)
            return F.struct(m["at"].alias("at"), F.lit(place).alias("place"), m["until"].alias("until"), F.lit(kind).alias("kind"), base.alias("base"), votes.alias("votes"))

        found = F.transform(F.col(f"at_{kind}"), one)
        # Short runs of digits are no candidates for cards; without this, every number in the corpus would be one.
        return F.filter(found, lambda s: s["base"] | (s["votes"]["check"] >= 0)) if kind == "card" else found

    return step.select("doc_id", F.concat(*map(judged, KINDS)).alias("found"))


def vote_counts(found: DataFrame) -> dict[tuple, int]:
    """How many candidates of a kind have which votes: at most 3 ** 4 rows a kind."""
    each = found.select(F.explode("found").alias("s")).groupBy("s.kind", *[F.col(f"s.votes.{v}").alias(v) for v in VOTES]).count()
    return {(r["kind"], *(r[v] for v in VOTES)): r["count"] for r in each.collect()}


def reliabilities(counts: dict[tuple, int], rounds: int = 50) -> tuple[dict, dict]:
    """By expectation-maximisation: P(vote | truth) of each labeler and kind, and each pattern's probability.

    A labeler starts out as better than chance; every rate is smoothed, so that none becomes 0 or 1.
    """
    kinds = {k[0] for k in counts}
    rate = {(kind, i, y, v): {1: 0.6, 0: 0.3, -1: 0.1}[v if y else -v] for kind in kinds for i in range(len(VOTES)) for y in (0, 1) for v in (-1, 0, 1)}
    prior = dict.fromkeys(kinds, 0.5)
    found: dict[tuple, float] = {}
    for _ in range(rounds):
        for key in counts:
            kind, votes = key[0], key[1:]
            odds = math.log(prior[kind]) - math.log(1 - prior[kind]) + sum(math.log(rate[kind, i, 1, v]) - math.log(rate[kind, i, 0, v]) for i, v in enumerate(votes))
            found[key] = 1 / (1 + math.exp(-max(-30.0, min(30.0, odds))))
        total: dict[tuple, float] = defaultdict(float)
        for key, n in counts.items():
            for y, p in ((1, found[key]), (0, 1 - found[key])):
                total[key[0], y] += n * p
                for i, v in enumerate(key[1:]):
                    total[key[0], i, y, v] += n * p
        for kind in kinds:
            prior[kind] = (total[kind, 1] + 1) / (total[kind, 1] + total[kind, 0] + 2)
            for i in range(len(VOTES)):
                for y in (0, 1):
                    for v in (-1, 0, 1):
                        rate[kind, i, y, v] = (total[kind, i, y, v] + 5 * {1: 0.6, 0: 0.3, -1: 0.1}[v if y else -v]) / (total[kind, y] + 5)
    return rate, found


def classifier(counts: dict[tuple, int], probable: dict[tuple, float], rounds: int = 300, penalty: float = 1e-3) -> dict[str, list[float]]:
    """By kind, the weights (constant first, then a vote for and a vote against of each labeler) of a logistic model.

    Trained on the probabilities of the vote patterns, each weighted by its count, by gradient descent.
    """
    weights: dict[str, list[float]] = {}
    for kind in {k[0] for k in counts}:
        rows = [([1.0, *(float(v == s) for v in key[1:] for s in (1, -1))], n, probable[key]) for key, n in counts.items() if key[0] == kind]
        total = sum(n for _, n, _ in rows)
        w = [0.0] * (1 + 2 * len(VOTES))
        for _ in range(rounds):
            slope = [penalty * x for x in w]
            for x, n, p in rows:
                error = 1 / (1 + math.exp(-sum(a * b for a, b in zip(w, x, strict=True)))) - p
                for i, v in enumerate(x):
                    slope[i] += n / total * error * v
            w = [a - 2.0 * b for a, b in zip(w, slope, strict=True)]
        weights[kind] = w
    return weights


def spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.9) -> DataFrame:
    """(doc_id, found): each row's spans as structs (at, place, until, kind, base, p); base spans and what the classifier adds."""
    found = materialise(candidates(docs, id_col, text_col), "pii-candidates")
    counts = vote_counts(found)
    weights = classifier(counts, reliabilities(counts)[1])

    def probability(s: Column) -> Column:
        out = F.lit(0.0)
        for kind, w in sorted(weights.items()):
            terms = [F.when(s["votes"][v] == sign, F.lit(x)).otherwise(F.lit(0.0)) for (v, sign), x in zip(((v, sign) for v in VOTES for sign in (1, -1)), w[1:], strict=True)]
            out = F.when(s["kind"] == kind, 1 / (1 + F.exp(-sum(terms, F.lit(w[0]))))).otherwise(out)
        return out

    scored = F.transform("found", lambda s: F.struct(s["at"].alias("at"), s["place"].alias("place"), s["until"].alias("until"), s["kind"].alias("kind"), s["base"].alias("base"), probability(s).alias("p")))
    return found.select("doc_id", F.filter(scored, lambda s: s["base"] | (s["p"] >= threshold)).alias("found"))


def report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans) of every row."""
    found = spans(docs, id_col, text_col)
    counts = [_spans.count_if(F.filter("found", lambda s: s["base"]), k).alias(f"n_{k}") for k in BASE]
    base = _spans.listed(F.filter("found", lambda s: s["base"]))
    return found.select("doc_id", *counts, F.sha2(base, 256).alias("base_sha256"), _spans.listed(F.col("found")).alias("spans"))
