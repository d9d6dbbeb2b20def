"""Instants against Python's own rules, and values that name none."""

from datetime import datetime, timedelta, timezone
from zoneinfo import ZoneInfo

from vacantia.operators.instants import with_instant

UTC = timezone.utc
EPOCH = datetime(1970, 1, 1, tzinfo=UTC)


def us(y, m, d, h=0, i=0, s=0, f=0):
    return (datetime(y, m, d, h, i, s, f, tzinfo=UTC) - EPOCH) // timedelta(microseconds=1)


def run(spark, rows):
    got = with_instant(spark.createDataFrame([(n, *r, 1, 2) for n, r in enumerate(rows)], "n int, v string, z string, f boolean, _t int, epoch_us int"), "v", "z", "f")
    assert got.columns == ["n", "v", "z", "f", "_t", "epoch_us"]
    return [r["epoch_us"] for r in sorted(got.collect(), key=lambda r: r["n"])]


def test_forms(spark):
    cases = [
        ("2024-05-27T04:16:58.719367Z", us(2024, 5, 27, 4, 16, 58, 719367)), ("2024-12-17t09:53:47z", us(2024, 12, 17, 9, 53, 47)), ("20240326T173018Z", us(2024, 3, 26, 17, 30, 18)),
        ("2025-09-17T07:07:38+02", us(2025, 9, 17, 5, 7, 38)), ("2025-11-27T04:26:27+1100", us(2025, 11, 26, 17, 26, 27)), ("2025-12-09 01:13:51,665", us(2025, 12, 9, 0, 13, 51, 665000)),
        ("Sun, 11 May 2025 01:02:57 +0100", us(2025, 5, 11, 0, 2, 57)), ("26 October 2025 12:43", us(2025, 10, 26, 11, 43)), ("Mar 10, 2024 2:47 PM", us(2024, 3, 10, 13, 47)), ("Mar 10, 2024 12:05 AM", us(2024, 3, 9, 23, 5)),
        ("2024-08-01 22:17:29 EDT", us(2024, 8, 2, 2, 17, 29)), ("2025-09-06T21:45:30+01:00[Europe/Dublin]", us(2025, 9, 6, 20, 45, 30)), ("2025-03-12T03:51:41[America/New_York]", us(2025, 3, 12, 7, 51, 41)),
        ("30.03.2025 01:27", us(2025, 3, 30, 0, 27)), (" 11/03/2024 02:09\t", us(2024, 3, 11, 1, 9)), ("2024-10-25", us(2024, 10, 24, 22)), ("2024-02-29", us(2024, 2, 28, 23)),
        ("1713252142", 1713252142 * 10**6), ("1759666226162", 1759666226162000), ("1725048265578414", 1725048265578414), ("1700568432.859", 1700568432859000), ("-1.5", -1500000), ("0", 0),
    ]
    assert run(spark, [(v, "Europe/Berlin", True) for v, _ in cases]) == [x for _, x in cases]
    # month first
    assert run(spark, [("11/03/2024 02:09", "America/New_York", False), ("11/03/2024 02:09", "America/New_York", None)]) == [us(2024, 11, 3, 7, 9)] * 2


def test_no_instants(spark):
    bad = ["2024-02-30", "2023-02-29", "2024-13-05T09:00:00Z", "2024-06-31 10:00:00", "0000-00-00 00:00:00", "2024-01-01T24:00:00Z", "2024-01-01T10:60:00Z", "ASAP", "", "  ", None, "2024-01-01T10:00:00 XYZ", "2024-01-01T10:00:00[Mars/Base]", "13:00", "Mar 10, 2024 13:47 PM", "1" * 18, "x" * 100_000, "2024-01-01T10:00:00+25:00"]
    assert run(spark, [(v, "Europe/Berlin", True) for v in bad]) == [None] * len(bad)
    assert run(spark, [("2024-01-01 10:00", None, True), ("2024-01-01 10:00", "No/Zone", True), ("2024-01-01T10:00:00Z", None, None)]) == [None, None, us(2024, 1, 1, 10)]


def test_wall_clocks_around_changes(spark):
    rows, want = [], []
    for zone in ("Europe/Berlin", "America/New_York", "Australia/Sydney", "Asia/Kolkata", "Europe/Dublin", "America/Los_Angeles"):
        for day in (datetime(2025, 3, 9), datetime(2025, 3, 30), datetime(2025, 10, 26), datetime(2025, 11, 2), datetime(2025, 10, 5), datetime(2025, 4, 6)):
            for minutes in range(0, 300, 30):
                local = day + timedelta(minutes=minutes)
                rows.append((local.strftime("%Y-%m-%dT%H:%M"), zone, True))
                # fold=0 is the first pass of a repeated hour, and the offset before the change in a gap
                want.append((local.replace(tzinfo=ZoneInfo(zone), fold=0).astimezone(UTC) - EPOCH) // timedelta(microseconds=1))
    assert run(spark, rows) == want


def test_empty(spark):
    assert run(spark, []) == []
