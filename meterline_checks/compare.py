"""Run every query beside its SQL: ``python -m meterline_checks.compare [sf_dir] [name ...]``."""

from __future__ import annotations

import sys
import time

import duckdb

from meterline_checks.oracles import ORACLES
from meterline_checks.queries import QUERIES
from meterline.session import local_session

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _family(kind: str) -> str:
    kind = kind.lower()
    names = {
        "int": "integer",
        "varchar": "string",
        "timestamp_ntz": "timestamp",
        "float64": "double",
    }
    return names.get(kind, kind)


def differences(spark, con, name: str, sf_dir: str) -> list[str]:
    """What differs between a query and its SQL; empty if they agree."""
    df = QUERIES[name](spark, sf_dir)
    sql = ORACLES[name]
    types = {r[0]: r[1] for r in con.execute(f"DESCRIBE {sql}").fetchall()}
    out = []
    if sorted(df.columns) != sorted(types):
        return [f"columns {sorted(df.columns)} != {sorted(types)}"]
    for field in df.schema.fields:
        ours, theirs = _family(field.dataType.simpleString()), _family(types[field.name])
        if ours != theirs:
            out.append(f"type of {field.name}: {ours} != {theirs}")
    columns = sorted(df.columns)
    ours = sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)
    quoted = ", ".join(f'"{c}"' for c in columns)
    theirs = sorted(con.execute(f"SELECT {quoted} FROM ({sql})").fetchall(), key=repr)
    if len(ours) != len(theirs):
        out.append(f"rows {len(ours)} != {len(theirs)}")
    wrong = [(a, b) for a, b in zip(ours, theirs) if a != b]
    if wrong:
        out.append(f"{len(wrong)} rows differ, first {wrong[0]}")
    return out


def main(argv: list[str]) -> int:
    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    names = argv[1:] or list(QUERIES)
    spark = local_session()
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    bad = 0
    for name in names:
        start = time.time()
        try:
            found = differences(spark, con, name, sf_dir)
        except Exception as error:  # report it and go on with the next query
            found = [f"{type(error).__name__}: {error}"]
        bad += bool(found)
        print(f"{'DIFF' if found else 'ok  '} {name} {time.time() - start:.1f}s", *found, sep="\n  ")
    print(f"{len(names) - bad} of {len(names)} agree")
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
