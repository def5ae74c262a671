import numpy as np
import pytest

from daymill.llm import urlfilter

URLS = ["https://a.example.org/es/1", "http://example.org/en/12?x", "http://EXAMPLE.org/en/2#t", "ftp://x.com/fr/", "http://com/de/x", "http://notcom/de/", "http://org", "http://org/", "nothing", "", None, "http://m.casino-win.example.net/zz", "http://casino-win.example.net.evil/zz", "x://h?a/b://c/d", "http://spam-farm.example.org/", "http://é.com/de/ü", "://", "http:///p"]


def brute(url, rules=urlfilter.RULES, blocked=urlfilter.BLOCKED_HOSTS):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
        host, rest = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut]), rest[cut:]
        path = rest[: min([rest.find(c) for c in "?#" if c in rest], default=len(rest))]
    under = lambda h: host == h or host.endswith("." + h)
    fits = max(((len(h + p), h + p, v) for h, p, v in rules if under(h) and path.startswith(p)), default=None)
    return host, path, *(fits[1:] if fits else (None, "block" if any(map(under, blocked)) else "allow"))


def test_every_url_is_judged(spark):
    pages = spark.createDataFrame([(i, u, "h") for i, u in enumerate(URLS)], "page_id long, url string, host string")
    got = {r[0]: tuple(r[3:]) for r in urlfilter.judge(pages).collect()}
    assert got == {i: brute(u) for i, u in enumerate(URLS)}
    assert urlfilter.allowed(pages).columns == pages.columns
    assert urlfilter.judge(pages.filter("page_id < 0")).count() == 0


def test_colliding_digests_do_not_decide(tmp_path, monkeypatch):
    monkeypatch.setattr(urlfilter.xxhash, "xxh64_intdigest", lambda s: len(s) % 3)
    path = str(tmp_path / "d")
    rules = [(f"h{i}.org", "/" * (i % 3), "block") for i in range(40)]
    urlfilter.Digests.write(path, rules, ["listed.org"])
    found = urlfilter.Digests(path).judge_all([(f"h{i}.org", "///") for i in range(50)] + [("x.listed.org", "")])
    assert [v for _, v in found] == ["block"] * 40 + ["allow"] * 10 + ["block"]


def test_lists_have_a_bound(tmp_path, monkeypatch):
    monkeypatch.setattr(urlfilter, "MOST_BYTES", 10)
    with pytest.raises(ValueError):
        urlfilter.Digests.write(str(tmp_path / "d"), urlfilter.RULES, [])


def test_empty_list(tmp_path):
    urlfilter.Digests.write(str(tmp_path / "d"), [], [])
    assert urlfilter.Digests(str(tmp_path / "d")).judge_all([("a.b", "/")]) == [(None, "allow")]
    assert np.array_equal(urlfilter.Digests(str(tmp_path / "d")).find([]), [])


def test_hosts_of_many_labels_take_linear_time(tmp_path):
    import time

    rules, blocked = [*urlfilter.RULES, ("a.a.a.example.org", "/", "block")], ["x.y.example.net"]
    urlfilter.Digests.write(str(tmp_path / "d"), rules, blocked)
    digests = urlfilter.Digests(str(tmp_path / "d"))
    hosts = ["a." * 20_000 + "example.org", "b" * 40_000 + ".example.org", "." * 40_000 + "org", "a." * 20_000 + "x.y.example.net", "a." * 20_000 + "xx.y.example.net", "xa.a.a.example.org", "..", "y.example.net"]
    began = time.time()
    found = digests.judge_all([(h, "/es/") for h in hosts])
    assert time.time() - began < 1
    assert found == [brute(f"http://{h}/es/", rules, blocked)[2:] for h in hosts]
