import itertools
import random

import numpy as np
import pytest

from chronopitch.operators import timestamps as T

LONDON = T.home_zone("Europe/London")
DMY = {by: ("dmy",) for by in "/.-"}


def one(text, time=None, zone=LONDON, orders=DMY):
    got = T.readings(text, time, zone, orders)
    return None if not got else got[0][2] or T.utc_text(got[0][1])


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("2024-06-13T20:11:26.498008954+0900", "2024-06-13T11:11:26.498008Z"), ("20240704T130236Z", "2024-07-04T13:02:36.000000Z"), ("1713982938", "2024-04-24T18:22:18.000000Z"),
        ("1690537048257", "2023-07-28T09:37:28.257000Z"), ("1728749050876458", "2024-10-12T16:04:10.876458Z"), ("19 Jul 2024 8:17 PM JST", "2024-07-19T11:17:00.000000Z"),
        ("Sun, 22 Dec 2024 06:35:26 GMT", "2024-12-22T06:35:26.000000Z"), ("Mar 4, 2025 7:52 AM", "2025-03-04T07:52:00.000000Z"), ("2024-06-09 04:31:16 America/New_York", "2024-06-09T08:31:16.000000Z"),
        ("31/03/2024 01:30", "nonexistent"), ("27.10.24 01:30", "ambiguous"), ("27 Oct 2024 1:30 AM BST", "2024-10-27T00:30:00.000000Z"), ("01/07/89 10:00", "2089-07-01T09:00:00.000000Z"),
        ("01/07/90 10:00", "1990-07-01T09:00:00.000000Z"), ("  2024-06-09T04:31:16Z ", "2024-06-09T04:31:16.000000Z"), ("2024-06-13", None), ("2024-13-05T10:00:00Z", None), ("31/02/2024 15:00", None),
        ("0000-00-00 00:00:00", None), ("25:61", None), ("yesterday", None), ("", None), (None, None), ("13:00 PM", None), ("2024-06-09 04:31:16 Mars/Base", None), ("9" * 5000, None),
    ],
)
def test_texts(text, expected):
    assert one(text) == expected


@pytest.mark.parametrize(
    ("date", "time", "expected"),
    [
        ("Sun 09-Apr-17", "12:45 PM", "2017-04-09T11:45:00.000000Z"), ("9.9.2014", "3pm", "2014-09-09T14:00:00.000000Z"), ("20121124", "1500", "2012-11-24T15:00:00.000000Z"),
        ("20/11/2021", "12.30", "2021-11-20T12:30:00.000000Z"), ("05/10/02", "14:00 GMT", "2002-10-05T14:00:00.000000Z"), ("06/02/24", "20:05+01:00", "2024-02-06T19:05:00.000000Z"),
        ("2023-10-28", "12pm", "2023-10-28T11:00:00.000000Z"), ("Saturday", "15:00", None), ("06/02/24", "TBC", None), ("06/02/24", "25:00", None), ("06/02/24", "", None), (None, "15:00", None),
    ],
)
def test_dates_with_times(date, time, expected):
    assert one(date, time) == expected


def test_the_path_keeps_to_one_order():
    texts = ["07/06/2024 10:00", "13/06/2024 10:00", "08/06/2024 10:00", "15/06/2024 10:00"]
    read = [T.readings(t, None, LONDON) for t in texts]
    assert [len(r) for r in read] == [2, 1, 2, 1]
    # The source's own day-first dates outweigh its usual order, for the same separator only.
    chosen = T.decide(read, T.beginning("mdy"))
    assert [T.utc_text(r[c][1])[:10] for r, c in zip(read, chosen)] == ["2024-06-07", "2024-06-13", "2024-06-08", "2024-06-15"]
    dotted = T.readings("01.02.2024 10:00", None, LONDON)
    assert dotted[T.decide([*read, dotted], T.beginning("mdy"))[-1]][0] == "mdy."
    assert dotted[T.decide([*read, dotted], T.beginning("dmy"))[-1]][0] == "dmy."


def brute(records, start):
    """All paths of readings with all sequences of states."""
    best = (np.inf, None)
    for path in itertools.product(*(range(len(r)) for r in records)):
        cost, last = start.copy(), None
        for r, k in zip(records, path):
            form, micros, _ = r[k]
            jump = T.BACK * np.log2(1 + max(0, last - micros) / 3.6e9) if last is not None else 0.0
            turn = np.full(8, np.inf)
            for s in range(8):
                t = s
                if form[:3] in ("dmy", "mdy"):
                    bit = 1 << "/-.".index(form[3])
                    t = s | bit if form.startswith("mdy") else s & ~bit
                turn[t] = min(turn[t], cost[s] + jump + T.SWITCH * (s != t))
            cost, last = turn, micros
        best = min(best, (float(cost.min()), path), key=lambda x: x[0])
    return best


def cost_of(records, chosen, start):
    return brute([[r[c]] for r, c in zip(records, chosen)], start)[0]


def test_the_path_is_the_cheapest_however_it_is_cut():
    rng = random.Random(4)
    for n in range(60):
        records, at = [], 1_700_000_000_000_000
        for _ in range(rng.randrange(1, 9)):
            at += rng.randrange(-40, 60) * 86_400_000_000
            if rng.random() < 0.3:
                records.append([("ymd", at, None)])
            else:
                by = rng.choice("/-.")
                both = [(f"dmy{by}", at, None), (f"mdy{by}", at + rng.randrange(-90, 90) * 86_400_000_000, None)]
                records.append(both if rng.random() < 0.6 else [rng.choice(both)])
        start = T.beginning(rng.choice(["dmy", "mdy"]))
        least = brute(records, start)[0]
        assert abs(cost_of(records, T.decide(records, start), start) - least) < 1e-9
        edges = sorted({0, len(records), *(rng.randrange(len(records) + 1) for _ in range(3))})
        pieces = [records[a:b] for a, b in zip(edges[:-1], edges[1:])]
        chosen = []
        for piece, (entry, first, *end) in zip(pieces, T.settle([(p[0], p[-1], T.transfer(p)) for p in pieces], start)):
            chosen += T.decide(piece, np.where(T.STATES == entry, 0.0, np.inf), first, tuple(end))
        assert abs(cost_of(records, chosen, start) - least) < 1e-9, n


def test_partitions_do_not_change_the_readings(spark):
    rng = random.Random(2)
    rows = [(f"k{i:04}", "s" if i % 3 else "t", f"{rng.randrange(1, 13):02}{rng.choice('/.')}{rng.randrange(1, 13 if i % 40 else 29):02}/2024 10:00".replace("./", ".."), None, i) for i in range(400)]
    rows = [(k, s, t if t.count("/") != 1 else t.replace("/", "."), None, p) for k, s, t, _, p in rows]
    df = spark.createDataFrame(rows, "row_key string, source string, text string, time string, place long")
    manifest = spark.createDataFrame([("s", "UTC", "mdy"), ("t", "UTC", "dmy")], "source string, source_timezone string, date_order string")
    got = []
    for n in ("1", "7", "23"):
        kept = spark.conf.get("spark.sql.shuffle.partitions")
        spark.conf.set("spark.sql.shuffle.partitions", n)
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        got.append(sorted(map(tuple, T.to_utc(df, manifest).collect())))
        spark.conf.set("spark.sql.shuffle.partitions", kept)
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert got[0] == got[1] == got[2] and len(got[0]) == 400


def test_tables(spark):
    rows = spark.createDataFrame([("a", "s", "03.04.24 10:00", None, 1), ("b", "s", "30.04.24 10:00", None, 2), ("b2", "s", "29.04.24 10:00", None, 3), ("b3", "s", "28.04.24 10:00", None, 4), ("c", None, "2024-01-01 10:00", None, 1), ("d", "s", None, None, 5)], "row_key string, source string, text string, time string, place long")
    manifest = spark.createDataFrame([("s", "America/New_York", "mdy")], "source string, source_timezone string, date_order string")
    got = {r["row_key"]: r["utc_text"] for r in T.to_utc(rows, manifest).collect()}
    # The source's own dates with dots can be read day first only, whatever the manifest says of dates in general.
    assert got == {"a": "2024-04-03T14:00:00.000000Z", "b": "2024-04-30T14:00:00.000000Z", "b2": "2024-04-29T14:00:00.000000Z", "b3": "2024-04-28T14:00:00.000000Z", "c": "2024-01-01T10:00:00.000000Z", "d": None}
    assert T.to_utc(rows.limit(0), manifest).count() == 0
