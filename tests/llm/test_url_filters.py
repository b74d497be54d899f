from __future__ import annotations

import datetime
import random
import re
from collections import defaultdict

from tributary.llm import url_filters

DAY = datetime.date(2024, 1, 1)
EVENTS = "list string, pattern string, at date, action string"
CAPTURES = "id int, url string, fetched_on date, decision string"


def day(n):
    return DAY + datetime.timedelta(days=n)


def brute(captures, events):
    single = {}
    for name, pattern, at, action in events:
        if None in (name, pattern, at) or action not in ("add", "remove"):
            continue
        pattern = re.sub("/+$", "", pattern.lower())
        if pattern:
            single[name, pattern, at] = max(single.get((name, pattern, at), ""), action)
    by = defaultdict(list)
    for (name, pattern, at), action in single.items():
        by[name, pattern].append((at, action))
    out = []
    for number, url, at, _ in captures:
        found = []
        match = re.match(r"[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:@]+)[^/?#]*([^?#]*)", url or "")
        if match and at:
            host = match[1].lower().rstrip(".")
            parts = [p for p in match[2].lower().split("/") if p]
            names = {".".join(host.split(".")[i:]) for i in range(host.count(".") + 1)}
            names |= {"/".join([host, *parts[:i]]) for i in range(1, len(parts) + 1)}
            for (name, pattern), own in by.items():
                before = [e for e in sorted(own) if e[0] <= at]
                if pattern in names and before and before[-1][1] == "add":
                    found.append((-len(pattern), name != "allow", name, pattern, before[-1][0]))
        best = min(found) if found else None
        out.append((number, *(best[2:] if best else (None, None, None)), best is None or best[2] == "allow"))
    return out


def decided(spark, captures, events, times=False, **options):
    kinds = [kind.replace(" date", " timestamp") if times else kind for kind in (CAPTURES, EVENTS)]
    out = url_filters.decided(spark.createDataFrame(captures, kinds[0]), spark.createDataFrame(events, kinds[1]), **options)

    def since(value):
        return value if times or value is None else value.date()

    return [(r.id, r[-1].list, r[-1].pattern, since(r[-1].since), r[-1].kept) for r in out.collect()]


def test_equals_brute_force(spark):
    random.seed(1)
    hosts = ["a.b.example.com", "b.example.com", "example.com", "other.org", "x.other.org"]
    events = [
        (random.choice(["block", "allow", "adult"]), random.choice(hosts) + random.choice(["", "", "/p", "/p/q/", "/P"]), day(random.randint(0, 90)), random.choice(["add", "add", "remove"]))
        for _ in range(120)
    ]
    events += [(None, "other.org", day(1), "add"), ("block", None, day(1), "add"), ("block", "/", day(1), "add"), ("block", "other.org", None, "add"), ("block", "other.org", day(1), "hide")]
    captures = [
        (i if i % 11 else None, random.choice(["http://", "https://u:p@", "HTTP://"]) + random.choice(hosts).upper() + random.choice(["", ":80", "./"]) + random.choice(["", "/p", "/p/q/r?x=/p", "/z#/p"]), day(random.randint(-5, 120)), "d")
        for i in range(300)
    ]
    captures += [(900, None, day(3), None), (901, "", day(3), None), (902, "no url", day(3), None), (903, "http://other.org/", None, None)]
    captures += [(904, "http://other.org/" + "/".join("p" * 20_000), day(50), None)] + [captures[0]] * 30
    want = brute(captures, events)
    for options in ({}, {"slice_days": 3}):
        assert sorted(decided(spark, captures, events, **options), key=str) == sorted(want, key=str)


def test_without_lists_or_captures(spark):
    rows = [(1, "http://other.org/", day(1), None)]
    assert decided(spark, rows, []) == [(1, None, None, None, True)]
    assert decided(spark, [], [("block", "other.org", day(1), "add")]) == []


def test_times_within_a_day(spark):
    def at(number, hour, minute=0):
        return datetime.datetime(2024, 1, number, hour, minute)

    events = [
        ("block", "other.org", at(2, 18), "add"),
        ("block", "other.org", at(2, 20), "remove"),
        ("block", "other.org", at(3, 7), "add"),
        ("block", "other.org", at(3, 7), "remove"),
        ("adult", "x.other.org", at(2, 18, 30), "add"),
        ("adult", "other.org:80", at(1, 0), "add"),
    ]
    captures = [(n, f"http://{host}other.org:80/p", when, None) for n, (host, when) in enumerate(
        (host, at(d, h, m)) for host in ("", "x.") for d in (1, 2, 3, 4) for h in (0, 9, 17, 18, 20, 23) for m in (0, 30)
    )]
    want = sorted(brute(captures, events), key=str)
    assert len({w[1] for w in want}) == 3
    for days in (1, 30):
        assert sorted(decided(spark, captures, events, times=True, slice_days=days), key=str) == want


def test_random_times(spark):
    random.seed(4)
    base = datetime.datetime(2024, 1, 1)

    def when():
        return base + datetime.timedelta(minutes=random.choice([0, 1, 59, 60, 24 * 60, 31 * 24 * 60]) * random.randint(0, 3))

    hosts = ["a.example.com", "example.com", "other.org"]
    events = [(random.choice(["block", "allow"]), random.choice(hosts), when(), random.choice(["add", "add", "remove"])) for _ in range(60)]
    captures = [(i, f"http://{random.choice(hosts)}/", when(), None) for i in range(200)]
    want = sorted(brute(captures, events), key=str)
    for days in (1, 30):
        assert sorted(decided(spark, captures, events, times=True, slice_days=days), key=str) == want
