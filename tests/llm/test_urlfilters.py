import random
from collections import Counter
from urllib.parse import urlsplit

from gleanery.llm import urlfilters

CAPTURES = "page_id long, url string, fetched_on int, lists string"
ENTRIES = "list string, key string, day int, listed boolean"


def keys(url):
    host = urlsplit(url.lower()).hostname
    if not host:
        return set()
    labels, steps = host.split("."), [s for s in urlsplit(url.lower()).path.split("/") if s]
    return {".".join(labels[i:]) for i in range(len(labels))} | {
        host + "/" + "/".join(steps[: i + 1]) for i in range(len(steps))
    }


def brute(captures, entries):
    history = {}
    for name, key, day, listed in entries:
        if key is not None and day is not None:
            days = history.setdefault((name, key), {})
            days[day] = days.get(day, False) or bool(listed)
    out = []
    for page, url, at, _ in captures:
        hits = []
        for (name, key), days in history.items():
            past = [d for d in days if at is not None and d <= at]
            if url and past and days[max(past)] and key in keys(url):
                hits.append((name, key))
        out.append((page, len(hits), ",".join(sorted({n for n, _ in hits})), " ".join(sorted({k for _, k in hits})), bool(hits)))
    return Counter(out)


def found(spark, captures, entries):
    result = urlfilters.filter_captures(
        spark.createDataFrame(captures, CAPTURES), spark.createDataFrame(entries, ENTRIES)
    )
    return Counter((r.page_id, r.n_active, r.lists, r.matched, r.blocked) for r in result.collect())


def test_equals_brute_force(spark):
    draw = random.Random(7)
    hosts = ["a.com", "x.a.com", "y.x.a.com", "b.org", "hot.net"]
    paths = ["", "/", "/p", "/p/q", "/p/q/r.html", "//p"]
    url = lambda: draw.choice(["http://", "HTTPS://u:p@"]) + draw.choice(hosts + ["hot.net"] * 5) + draw.choice(["", ":80"]) + draw.choice(paths) + draw.choice(["", "?a=/z", "#t"])
    captures = [(i % 300, url(), draw.randrange(60), "c") for i in range(400)]
    captures += [(1, None, 3, None), (2, "", 3, None), (3, "no url", 3, None), (None, "http://a.com/", None, None), (4, "http://a.com/", 10, "")] * 2
    names = hosts + ["com", "a.com/p", "hot.net/p/q", "x.a.com/p", None]
    entries = [(draw.choice("kl"), draw.choice(names), draw.choice([None, *range(60)]), draw.choice([True, False, None])) for _ in range(150)]
    assert found(spark, captures, entries) == brute(captures, entries)
    assert found(spark, captures, []) == brute(captures, [])
    assert found(spark, [], entries) == Counter()


def test_intervals(spark):
    rows = [("l", "k", 1, True), ("l", "k", 1, True), ("l", "k", 5, False), ("l", "k", 5, True), ("l", "k", 9, False), ("l", "j", 2, False)]
    got = urlfilters.intervals(spark.createDataFrame(rows, ENTRIES)).collect()
    assert sorted(map(tuple, got)) == [("l", "k", 1, 5), ("l", "k", 5, 9)]
