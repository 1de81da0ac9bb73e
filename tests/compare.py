"""python tests/compare.py FOLDER [NAME...]: each query against its SQL; prints what differs."""

import math
import sys
import time
from collections import Counter
from datetime import datetime
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


def _value(x):
    if isinstance(x, float):
        return "nan" if math.isnan(x) else round(x, 5) + 0.0
    if isinstance(x, (list, tuple)):
        return tuple(map(_value, x))
    return x.isoformat() if isinstance(x, datetime) else x


def bag(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda k: columns[k])
    return Counter(tuple(_value(r[k]) for k in order) for r in rows)


def sql_rows(folder: str, text: str) -> Counter:
    con = duckdb.connect()
    for p in sorted(Path(folder).glob("*.parquet")):
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM read_parquet('{p}{'/*' if p.is_dir() else ''}')")
    done = con.execute(text)
    return bag([d[0] for d in done.description], done.fetchall())


def spark_rows(df) -> Counter:
    return bag(df.columns, [tuple(r) for r in df.collect()])


def main(folder: str, names: list[str]) -> int:
    import __spark_entry__ as entry
    from weftline.session import build_session

    spark = build_session("compare", "local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false", spark__driver__memory="6g")
    spark.sparkContext.setLogLevel("ERROR")
    bad, sql = 0, entry.oracle_sql()
    for name, f in entry.queries().items():
        if names and name not in names:
            continue
        t = time.time()
        df = f(spark, folder)
        rows = spark_rows(df)
        took, wanted = time.time() - t, sql_rows(folder, sql[name]) if name in sql else None
        same = wanted is None or rows == wanted
        bad += not same
        print(f"{'ok ' if same else 'BAD'} {name}: {sum(rows.values())} rows, {took:.1f} s" + ("" if wanted is not None else ", no SQL"), flush=True)
        if not same:
            print("   only Spark", list((rows - wanted).items())[:4], "\n   only SQL  ", list((wanted - rows).items())[:4])
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]))
