from __future__ import annotations

import random

from tallyline.llm import urlfilter


def state_at(events, time):
    """Whether the last dated entry at or before the time lists; listed wins among equal times."""
    past = [at for at, _ in events if at <= time]
    return bool(past) and any(listed for at, listed in events if at == max(past))


def test_against_a_scan_of_the_history(spark):
    rng = random.Random(9)
    hosts = ["a.b.example.com", "b.example.com", "example.com", "other.org", "x.other.org"]
    entries = [("domain", rng.choice(hosts), rng.randrange(400) * 86_400, rng.random() < 0.6) for _ in range(120)]
    urls = [f"https://{h}/{p}" for h in hosts for p in ("", "p", "q?x=1")]
    entries += [("url", rng.choice(urls), rng.randrange(400) * 86_400, rng.random() < 0.6) for _ in range(60)]
    captures = [(i, rng.choice(urls) + rng.choice(["", "#part"]), rng.randrange(-50, 500) * 43_200) for i in range(400)]
    list_rows = spark.createDataFrame(entries, "kind string, entry string, at long, listed boolean")
    got = urlfilter.filter_captures(spark.createDataFrame(captures, "page_id long, url string, fetched_at long"), list_rows)
    history = {}
    for kind, entry, at, listed in entries:
        history.setdefault((kind, entry), []).append((at, listed))
    for r in got.collect():
        bare = r["url"].split("#")[0]
        host = bare.split("/")[2]
        names = [("url", bare)] + [("domain", host.split(".", i)[-1]) for i in range(host.count(".") + 1)]
        active = sorted(f"{k}:{e}" for k, e in names if state_at(history.get((k, e), []), r["fetched_at"]))
        assert (r["n_active"], r["entry"], r["blocked"]) == (len(active), active[0] if active else None, bool(active))


def test_odd_rows(spark):
    entries = [
        ("domain", "a.com", 100, True, 1), ("domain", "a.com", 200, False, 1), ("domain", "a.com", 200, True, 1), ("domain", "a.com", 300, False, 1),
        ("domain", None, 1, True, 1), (None, "a.com", 1, True, 1), ("url", "http://a.com/", None, True, 1), ("url", "not a url", 0, True, 1),
        ("domain", "com", 0, None, 1),
    ]
    captures = [
        (1, "http://A.com./x", 99, 0), (2, "http://u:p@a.com:80/x", 100, 0), (3, "http://a.com", 250, 0), (4, "http://a.com", 300, 0),
        (5, None, 150, 0), (6, "http://a.com", None, 0), (None, "not a url", 150, 0), (7, "http://xa.com", 150, 0), (2, "http://u:p@a.com:80/x", 100, 0),
        (8, "", 150, 0),
    ]
    list_rows = spark.createDataFrame(entries, "kind string, entry string, at long, listed boolean, period int")
    rows = spark.createDataFrame(captures, "page_id long, url string, fetched_at long, capture int")
    got = sorted(((r["page_id"], r["blocked"]) for r in urlfilter.filter_captures(rows, list_rows, period=30).collect()), key=repr)
    want = [(1, False), (2, True), (2, True), (3, True), (4, False), (5, False), (6, False), (7, False), (8, False), (None, True)]
    assert got == sorted(want, key=repr)
    assert urlfilter.filter_captures(rows.limit(0), list_rows).count() == 0
    assert urlfilter.filter_captures(rows, list_rows.limit(0)).where("blocked").count() == 0


def test_hot_entry_is_dealt_by_period(spark):
    """One entry with a long history gives the same intervals however time is cut."""
    entries = [("domain", "hot.com", i * 1000, i % 3 != 0) for i in range(500)]
    rows = spark.createDataFrame(entries, "kind string, entry string, at long, listed boolean")
    spans = [sorted((r["since"], r["until"] or -1) for r in urlfilter.validity(rows, p).collect()) for p in (10, 7777, 10**9)]
    assert spans[0] == spans[1] == spans[2] and len(spans[0]) == 333


def test_long_urls_and_hosts_of_many_labels(spark):
    host = ".".join(f"l{i}" for i in range(300)) + ".com"
    entries = [("domain", "l299.com", 0, True), ("domain", host, 5, True), ("url", f"http://{host}/" + "x" * 200_000, 7, True)]
    captures = [(1, f"http://{host}/" + "x" * 200_000 + "#y", 10), (1, f"http://{host}/" + "x" * 199_999, 10), (1, f"http://{host}/", 3)]
    found = urlfilter.filter_captures(
        spark.createDataFrame(captures, "page_id long, url string, fetched_at long"),
        spark.createDataFrame(entries, "kind string, entry string, at long, listed boolean"),
    )
    assert {(len(r["url"]), r["n_active"]) for r in found.collect()} == {(len(c[1]), n) for c, n in zip(captures, (3, 2, 1))}
