"""URL filter: splitting, fixed rules and templates."""

from __future__ import annotations

import re

import pytest

from sigflow.llm import urls

URLS = [
    None, "", "no scheme", "://", "http://", "HTTP://A.Example.ORG/en/1", "http://example.org/en/2", "http://sub.example.org/en/12/x",
    "http://badexample.org/en/1", "http://x.com/fr/", "http://x.com/fr", "http://com/de/1", "http://x.com/de/1?q=/fr/",
    "http://x.com?p=/de/", "http://x.com#/de/", "http://x.com//de/", "http://a://b/c", "http://u:p@Host.NET:80/P?x#y",
    "http://ÀB.net/ü\n/line", "http://org/", "http://org", "http://.org/", "http://x.com/de", "http://a.b/" + "s/" * 500, "http://é.com/fr/é",
]


def split(url):
    at = (url or "").find("://")
    if at < 0:
        return "", ""
    rest = url[at + 3 :]
    host = re.match(r"[^/?#]*", rest)[0]
    return re.sub("[A-Z]", lambda m: m[0].lower(), host), re.match(r"[^?#]*", rest[len(host) :])[0]


def rule(host, path):
    best = None
    for r in urls.RULES:
        h, _, p = r.pattern.partition("/")
        if (host == h or host.endswith("." + h)) and path.startswith("/" + p) and (best is None or len(r.pattern) > len(best.pattern)):
            best = r
    return best


@pytest.fixture(scope="module")
def judged(spark):
    pages = spark.createDataFrame([(i, u, "h") for i, u in enumerate(URLS)], "page_id long, url string, host string")
    labels = spark.createDataFrame([], "id long, bad int")
    return {r.page_id: r for r in urls.judge_urls(pages, labels).collect()}


def test_host_path_and_rule(judged):
    assert len(judged) == len(URLS)
    for i, u in enumerate(URLS):
        host, path = split(u)
        want = rule(host, path)
        r = judged[i]
        assert (r.host, r.path, r.rule) == (host, path, want and want.pattern), u
        assert r.verdict == (want.verdict if want else "allow")


def test_impure_template_is_rejected_and_similar_branches_merge(spark):
    rows, labels = [], []

    def add(url, bad=None):
        rows.append((len(rows), url))
        if bad is not None:
            labels.append((len(rows) - 1, bad))

    for i in range(60):  # articles are fine, one section is not
        add(f"http://h.net/news/{i}.html", 0)
        add(f"http://h.net/casino/{i}.html", 1)
        add(f"http://h.net/blog/{i}.html", 0 if i % 2 else None)
        add(f"http://h.net/user-{'abcdefghij'[i % 10] * (i + 1)}/home", 0)
    add("http://h.net/casino/999.html")
    add("http://h.net/news/999.html")
    add("http://other.net/casino/1.html")
    pages = spark.createDataFrame(rows, "page_id long, url string")
    known = spark.createDataFrame([*labels, (0, None), (1, 0)], "id long, bad int")
    out = {r.page_id: r for r in urls.judge_urls(pages, known).collect()}
    verdict = {u: out[i].verdict for i, u in rows}
    assert verdict["http://h.net/casino/999.html"] == "block" and verdict["http://h.net/news/999.html"] == "allow"
    assert verdict["http://other.net/casino/1.html"] == "allow"
    template = {u: out[i].template for i, u in rows}
    assert template["http://h.net/casino/999.html"].startswith("h.net/casino/")
    assert template[rows[3][1]].startswith("h.net/*/")  # rare children of a parent with many


def test_no_python_in_the_plan(spark):
    pages = spark.createDataFrame([(1, "http://a.net/x")], "page_id long, url string")
    labels = spark.createDataFrame([(1, 1)], "id long, bad int")
    plan = urls.judge_urls(pages, labels)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


def test_empty_and_repeated(spark):
    labels = spark.createDataFrame([], "id long, bad int")
    none = spark.createDataFrame([], "page_id long, url string")
    assert urls.judge_urls(none, labels).count() == 0
    twice = spark.createDataFrame([(1, "http://a.net/x"), (1, "http://a.net/x"), (None, None)], "page_id long, url string")
    assert urls.judge_urls(twice, labels).count() == 3


def test_levels_follow_the_labelled_paths_only(spark, monkeypatch):
    """Paths without a labelled page end where their rate is settled, however long they are."""
    rows = [(i, f"http://trap.net/a/b/c{i}/" + f"{'xyz'[i % 3]}/" * 200 + str(i)) for i in range(12)]
    rows += [(100 + i, f"http://trap.net/a/b/news/{'pq'[i % 2]}/{'rs'[i % 2]}") for i in range(40)]
    labels = [(100 + i, i % 2) for i in range(40)]
    rounds = []
    level = urls._level
    monkeypatch.setattr(urls, "_level", lambda *a, **k: rounds.append(1) or level(*a, **k))
    pages = spark.createDataFrame(rows, "page_id long, url string")
    out = {r.page_id: r for r in urls.judge_urls(pages, spark.createDataFrame(labels, "id long, bad int")).collect()}
    assert len(out) == len(rows) and len(rounds) <= urls.DEPTH + 3
    assert all(out[i].template.endswith("/**") for i in range(12))
    assert len({round(out[i].purity, 12) for i in range(12)}) <= 2
    assert all(out[100 + i].verdict == ("block" if i % 2 else "allow") for i in range(40))


def test_sections_below_dates_are_told_apart(spark):
    """Branches at the fourth level and below, paths that end on the way, and a very long one."""
    rows, labels = [], []
    for i in range(40):
        day = f"http://h.net/2024/{i % 12 + 1:02}/{i % 28 + 1:02}"
        for url, bad in ((f"{day}/casino/{i}/play", 1), (f"{day}/news/world/europe/{i}.html", 0), (f"{day}/news/world/{i}", 0), (day, 0)):
            labels.append((len(rows), bad))
            rows.append((len(rows), url))
    more = ["http://h.net/2023/01/01/casino/7/play", "http://h.net/2023/01/01/news/world/europe/7.html", "http://h.net/2023/01/01",
            "http://h.net/2023/01/01/news/world/7", "http://h.net/2023/01/01/news/" + "x/" * 300]
    rows += [(1000 + i, u) for i, u in enumerate(more)]
    pages = spark.createDataFrame(rows, "page_id long, url string")
    out = {r.page_id: r for r in urls.judge_urls(pages, spark.createDataFrame(labels, "id long, bad int")).collect()}
    assert len(out) == len(rows)
    assert all(out[d].verdict == ("block" if bad else "allow") for d, bad in labels)
    assert [out[1000 + i].verdict for i in range(5)] == ["block", *["allow"] * 4]
    assert len({out[1000 + i].template for i in range(5)}) == 5
    assert out[1000].template == out[0].template and "/casino" in out[0].template
