"""Comparison of a Spark result with rows of DuckDB, regardless of order."""

import datetime
import math


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None)
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    return v


def ordered(rows):
    return sorted(rows, key=lambda r: tuple((x is None, str(x)) for x in r))


def check(spark, data, duck, name):
    import __spark_entry__ as entry

    df = entry.queries()[name](spark, data)
    cols = sorted(df.columns)
    mine = ordered(tuple(plain(x) for x in r) for r in df.select(*cols).collect())
    got = duck.execute(entry.oracle_sql()[name])
    names = [d[0] for d in got.description]
    assert sorted(names) == cols
    at = [names.index(c) for c in cols]
    theirs = ordered(tuple(plain(r[i]) for i in at) for r in got.fetchall())
    assert mine == theirs
