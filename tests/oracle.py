"""Compare registered queries with their SQL in DuckDB: ``python tests/oracle.py SF_DIR [name ...]``."""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def duck(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _plain(value):
    if hasattr(value, "item"):
        value = value.item()
    if isinstance(value, float) and value != value:
        return None
    return value


_KIND = {"string": "text", "large_string": "text"}


def as_rows(table):
    """(sorted column names, kinds, sorted rows) of an Arrow table."""
    names = sorted(table.column_names)
    kinds = {n: _KIND.get(str(table.schema.field(n).type), str(table.schema.field(n).type).replace(", tz=UTC", "")) for n in names}
    columns = [table.column(n).to_pylist() for n in names]
    return names, kinds, sorted((tuple(_plain(v) for v in row) for row in zip(*columns)), key=repr)


def compare(spark, con, sf_dir: str, fn, sql: str) -> list[str]:
    ours, theirs = as_rows(fn(spark, sf_dir).toArrow()), as_rows(con.sql(sql).to_arrow_table())
    problems = []
    if ours[0] != theirs[0]:
        return [f"columns differ: {sorted(set(ours[0]) ^ set(theirs[0]))}"]
    for n in ours[0]:
        if ours[1][n] != theirs[1][n]:
            problems.append(f"type of {n}: {ours[1][n]} vs {theirs[1][n]}")
    if len(ours[2]) != len(theirs[2]):
        problems.append(f"rows: {len(ours[2])} vs {len(theirs[2])}")
    elif not ours[2]:
        problems.append("no rows")
    bad = [(a, b) for a, b in zip(ours[2], theirs[2]) if repr(a) != repr(b)]
    for a, b in bad[:2]:
        problems.append("; ".join(f"{n}: {x!r} vs {y!r}" for n, x, y in zip(ours[0], a, b) if repr(x) != repr(y))[:600])
    if bad:
        problems.append(f"{len(bad)} rows differ")
    return problems


def main() -> int:
    import __spark_entry__ as entry
    from tidemark.session import local_session

    sf_dir, only = sys.argv[1], sys.argv[2:]
    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf_dir)
    oracles, failed = entry.oracle_sql(), []
    for name, fn in entry.queries().items():
        if only and not any(name.startswith(o) for o in only):
            continue
        start = time.time()
        try:
            if name in oracles:
                problems = compare(spark, con, sf_dir, fn, oracles[name])
            else:
                n = len(fn(spark, sf_dir).toArrow())
                problems = [] if n else ["no rows"]
        except Exception as error:  # report and go on
            problems = [f"{type(error).__name__}: {str(error)[:1500]}"]
        print(f"{'FAIL' if problems else 'ok  '} {name} {time.time() - start:.1f}s{'' if name in oracles else ' (rows only)'}", flush=True)
        for p in problems:
            print("     ", p, flush=True)
        failed += [name] if problems else []
    print(f"failed: {failed}")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
