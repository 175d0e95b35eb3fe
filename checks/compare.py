"""Run registered queries next to their SQL: python -m checks.compare [folder] [query ...]"""

import sys
import time

import duckdb

from checks import catalog, oracle
from stipend.session import local_session

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def oracle_rows(folder: str, sql: str) -> tuple[list[str], list[tuple]]:
    """Result of `sql`, columns by name and rows in canonical order."""
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    result = con.execute(sql)
    return canonical([d[0] for d in result.description], result.fetchall())


def canonical(columns: list[str], rows: list[tuple]) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    picked = [tuple(row[i] for i in order) for row in rows]
    return [columns[i] for i in order], sorted(picked, key=lambda row: [
        (v is None, "" if v is None else str(v)) for v in row
    ])


def spark_rows(df) -> tuple[list[str], list[tuple]]:
    return canonical(df.columns, [tuple(row) for row in df.collect()])


def main(folder: str, names: list[str]) -> int:
    spark = local_session()
    spark.sparkContext.setLogLevel("ERROR")
    wrong = 0
    for name in names or catalog.QUERIES:
        start = time.perf_counter()
        try:
            columns, rows = spark_rows(catalog.QUERIES[name](spark, folder))
        except Exception as error:  # a failing query must not hide the others
            print(f"FAIL {name}: {str(error)[:1500]}")
            wrong += 1
            continue
        spent = time.perf_counter() - start
        expected_columns, expected = oracle_rows(folder, oracle.QUERIES[name])
        same = columns == expected_columns and rows == expected
        types = [type(v).__name__ for v in (rows[0] if rows else ())]
        expected_types = [type(v).__name__ for v in (expected[0] if expected else ())]
        print(f"{'ok  ' if same else 'DIFF'} {name}: {len(rows)} rows, {spent:.2f} s"
              + ("" if types == expected_types else f" types {types} / {expected_types}"))
        if not same:
            wrong += 1
            print("   ", len(rows), columns, "\n   ", len(expected), expected_columns)
            for ours, theirs in zip(rows, expected):
                if ours != theirs:
                    print("   ", ours, "\n   ", theirs)
                    break
    return wrong


if __name__ == "__main__":
    args = sys.argv[1:]
    sys.exit(main(args[0] if args else "/root/testdata/sf0.01", args[1:]) > 0)
