from __future__ import annotations

import datetime as dt

from chatlens.llm import urls

ENTRIES = "scope string, pattern string, action string, entry_date date"
CAPTURES = "page_id long, url string, fetch_date date"


def day(n: int) -> dt.date:
    return dt.date(2024, 1, n)


def test_entries_hold_from_their_date_to_the_next(spark):
    entries = spark.createDataFrame(
        [
            ("host", "bad.example.com", "block", day(5)),
            ("host", "bad.example.com", "remove", day(10)),
            ("domain", "example.com", "allow", day(3)),
            ("prefix", "bad.example.com/en", "allow", day(8)),
            ("host", "twice.org", "allow", day(2)),
            ("host", "twice.org", "block", day(2)),
            ("host", None, "block", day(1)),
            ("host", "undated.org", "block", None),
            ("host", "odd.org", "nonsense", day(1)),
        ],
        ENTRIES,
    )
    cases = [
        ("https://user@www.BAD.example.com:8080/de/1", day(4), "domain", True),
        ("https://bad.example.com/de/1", day(5), "host", False),
        ("https://bad.example.com/en/1", day(8), "prefix", True),
        ("https://bad.example.com/de/1", day(10), "domain", True),
        ("http://bad.example.com", day(2), None, True),
        ("http://twice.org/", day(2), "host", False),
        ("http://undated.org/", day(9), None, True),
        ("http://odd.org/", day(9), None, True),
        ("not a url", day(9), None, True),
        (None, day(9), None, True),
        ("http://twice.org/", None, None, True),
    ]
    captures = spark.createDataFrame([(k, u, d) for k, (u, d, _, _) in enumerate(cases)], CAPTURES)
    found = {r["page_id"]: (r["scope"], r["kept"]) for r in urls.judge(captures, entries).collect()}
    assert found == {k: (scope, kept) for k, (_, _, scope, kept) in enumerate(cases)}


def test_repeated_captures_and_clashing_columns(spark):
    entries = spark.createDataFrame([("host", "a.org", "block", day(1))], ENTRIES)
    captures = spark.createDataFrame([(1, "http://a.org/x", day(2))] * 3 + [(None, None, None)], CAPTURES)
    captures = captures.selectExpr("*", "'theirs' AS host", "'theirs' AS kept", "'theirs' AS scope")
    rows = urls.judge(captures, entries).collect()
    assert sorted(r["kept"] for r in rows) == [False, False, False, True]
    assert urls.kept_captures(captures, entries).count() == 1


def test_empty_tables(spark):
    entries = spark.createDataFrame([], ENTRIES)
    captures = spark.createDataFrame([(1, "http://a.org/x", day(2))], CAPTURES)
    assert [r["kept"] for r in urls.judge(captures, entries).collect()] == [True]
    assert urls.judge(captures.limit(0), entries).count() == 0
