"""Compare registered queries with their SQL twins: ``python -m tests.oracle [sf_dir] [names...]``."""

from __future__ import annotations

import math
import sys
import time
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return connection


def plain(value):
    if isinstance(value, bool) or value is None or isinstance(value, str):
        return value
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    if isinstance(value, float) or hasattr(value, "as_integer_ratio"):
        number = float(value)
        return "nan" if math.isnan(number) else number + 0.0
    return value


def as_counter(names: list[str], rows) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(plain(row[i]) for i in order) for row in rows)


def difference(frame, sql: str, connection) -> str:
    """'' if equal, otherwise what differs."""
    got_names = frame.columns
    got = as_counter(got_names, frame.collect())
    result = connection.execute(sql)
    want_names = [d[0] for d in result.description]
    want = as_counter(want_names, result.fetchall())
    if sorted(got_names) != sorted(want_names):
        return f"columns {sorted(got_names)} vs {sorted(want_names)}"
    if got != want:
        return f"{sum(got.values())} vs {sum(want.values())} rows; only got {list((got - want))[:2]}; only wanted {list((want - got))[:2]}"
    return "" if got else "no rows"


def main() -> None:
    sys.path.insert(0, ".")
    import __spark_entry__ as entry
    from larkspur.session import build_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("oracle", "local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false",
                          spark__driver__memory="8g", spark__ui__showConsoleProgress="false")
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(sf_dir)
    builders, oracles = entry.queries(), entry.oracle_sql()
    names = sys.argv[2:] or list(builders)
    bad = 0
    for name in names:
        start = time.time()
        try:
            if name in oracles:
                found = difference(builders[name](spark, sf_dir), oracles[name], connection)
                status = "ok" if not found else "DIFF " + found[:1500]
            else:
                status = f"rows {builders[name](spark, sf_dir).count()}"
        except Exception as error:  # report and go on with the next query
            status = "ERROR " + str(error)[:700]
        bad += status.startswith(("DIFF", "ERROR"))
        print(f"{name:24s} {time.time() - start:6.2f}s {status}", flush=True)
    print("bad:", bad, "of", len(names))
    spark.stop()


if __name__ == "__main__":
    main()
