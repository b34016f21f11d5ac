"""Run registered queries next to their SQL and report differences."""

import sys
import time
from pathlib import Path

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _kind(value):
    if isinstance(value, bool):
        return value
    if isinstance(value, float):
        return "nan" if value != value else round(value, 6) + 0.0
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_kind(r[i]) for i in order) for r in rows), key=repr)


def difference(df, con, sql: str) -> str | None:
    """None when names, value types and all rows agree."""
    want = con.execute(sql)
    names = [d[0] for d in want.description]
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(set(names) ^ set(df.columns))}"
    expected, got = rows_of(names, want.fetchall()), rows_of(df.columns, [tuple(r) for r in df.collect()])
    if len(expected) != len(got):
        return f"rows {len(got)}, SQL {len(expected)}"
    for a, b in zip(got, expected):
        if a != b or [type(x) for x in a] != [type(x) for x in b]:
            columns = sorted(names)
            return "; ".join(f"{c}: {x!r} / SQL {y!r}" for c, x, y in zip(columns, a, b)
                             if x != y or type(x) is not type(y))
    return None


def main(sf_dir: str, only: list[str]) -> int:
    sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
    import __spark_entry__ as entry
    from dispatchlens import session

    spark = session.session("compare", **{"spark.master": "local[8]", "spark.sql.shuffle.partitions": "8",
                                          "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
                                          "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    con, sqls, bad = connect(sf_dir), entry.oracle_sql(), 0
    for name, run in entry.queries().items():
        if only and name not in only:
            continue
        start = time.time()
        try:
            df = run(spark, sf_dir)
            result = difference(df, con, sqls[name]) if name in sqls else f"no SQL; {df.count()} rows"
        except Exception as problem:
            result = f"{type(problem).__name__}: {str(problem)[:600]}"
        bad += result is not None and not result.startswith("no SQL")
        print(f"{name:28s} {time.time() - start:6.1f}s {result or 'ok'}", flush=True)
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]))
