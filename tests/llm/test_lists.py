"""Temporal lists against brute force."""

import datetime as dt
import random

from conftest import as_rows
from pricegrid.llm.url_lists import dealt_intervals, intervals, listed

DAY = dt.date(2024, 3, 1)


def test_listed(spark):
    r = random.Random(2)
    day = lambda: DAY + dt.timedelta(days=r.randrange(80))
    urls = ["http://a.b.c/x", "https://b.c", "http://c:80/", "ftp://B.C/?q", "nothing", "", None, "http://x.y#z"]
    captures = [(i, r.choice(urls), r.choice([day(), day(), None]), "n") for i in range(120)]
    captures += captures[:5]
    patterns = [("host", "b.c"), ("host", "c"), ("url", "https://b.c"), ("host", "a.b.c"), ("host", None), ("url", "nothing")]
    entries = []
    for _ in range(60):
        name, (kind, pattern) = r.choice(["x", "y", "ok"]), r.choice(patterns)
        entries.append((name, name == "ok", kind, pattern, r.random() < 0.6, r.choice([day(), day(), day(), None])))

    def active(url, at):
        host = ""
        if url and "://" in url:
            host = url.split("://")[1]
            for c in "/:?#":
                host = host.split(c)[0]
            host = host.lower()
        names = {".".join(host.split(".")[i:]) for i in range(host.count(".") + 1)} if host else set()
        found = []
        for name in ("x", "y", "ok"):
            for kind, pattern in patterns:
                if pattern is None or not (kind == "url" and pattern == url or kind == "host" and pattern in names):
                    continue
                past = sorted((e[5], e[4]) for e in entries if (e[0], e[2], e[3]) == (name, kind, pattern) and e[5] and e[5] <= at)
                if past and past[-1][1]:
                    found.append(name)
        return host, found

    expected = []
    for key, url, at, _ in captures:
        host, found = active(url, at) if at and url is not None else (active(url, DAY)[0], [])
        lists = ",".join(sorted(set(found)))
        blocked = bool(found) and "ok" not in found
        expected.append(tuple(map(str, (key, host, at, len(found), lists, blocked))))
    frame = spark.createDataFrame(captures, "page_id bigint, url string, fetched_on date, host string")
    table = spark.createDataFrame(entries, "list string, allow boolean, kind string, pattern string, added boolean, on date")
    names = ("page_id", "host", "fetched_on", "n_active", "lists", "blocked")
    assert as_rows(listed(frame, table), *names) == sorted(expected)
    assert any(e[5] == "True" for e in expected)
    assert listed(frame, table.limit(0)).where("blocked or n_active > 0").count() == 0
    assert listed(frame.limit(0), table).count() == 0


def test_times_of_day_and_open_intervals(spark):
    at = dt.datetime
    entries = [
        ("x", False, "host", "a", True, at(2024, 1, 5, 10)), ("x", False, "host", "a", False, at(2024, 1, 5, 18)),
        ("x", False, "host", "b", True, at(2024, 1, 5, 15)), ("x", False, "url", "http://c", True, at(2024, 1, 5)),
        ("x", False, "host", "d", True, at(2024, 1, 5, 9)), ("x", False, "host", "d", False, at(2024, 1, 5, 9)),
    ]
    asked = {
        ("http://a", at(2024, 1, 5, 9)): 0, ("http://a", at(2024, 1, 5, 10)): 1, ("http://a", at(2024, 1, 5, 17, 59)): 1,
        ("http://a", at(2024, 1, 5, 18)): 0, ("http://b", at(2024, 1, 5, 9)): 0, ("http://b", at(2101, 7, 1)): 1,
        ("http://c", at(2024, 1, 5)): 1, ("http://c", at(2024, 1, 4, 23, 59, 59)): 0, ("http://d", at(2024, 2, 1)): 1,
    }
    frame = spark.createDataFrame([(i, u, t) for i, (u, t) in enumerate(asked)], "page_id bigint, url string, fetched_on timestamp")
    table = spark.createDataFrame(entries, "list string, allow boolean, kind string, pattern string, added boolean, on timestamp")
    rows = {r["page_id"]: r["n_active"] for r in listed(frame, table).collect()}
    assert [rows[i] for i in range(len(asked))] == list(asked.values())


def test_intervals_only_reach_periods_with_captures(spark):
    spans = intervals(spark.sql("SELECT 'x' AS list, false AS allow, 'host' AS kind, 'h' || id AS pattern, true AS added, DATE'2000-01-01' AS on FROM range(50)"))
    asked = spark.sql("SELECT 'host' AS kind, 'h' || id AS pattern, CAST(period AS BIGINT) AS period FROM range(40), (SELECT explode(array(500, 700, 700)) AS period)")
    assert dealt_intervals(spans, asked).count() == 80
