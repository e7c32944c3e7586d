"""Run registered queries and their SQL side by side: python tests/compare.py [folder] [query …]."""

import sys
import tempfile
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import __spark_entry__ as contract  # noqa: E402
from shelfsense.session import build_session  # noqa: E402


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    # Spilled rows of a stopped run must not end up in the working folder.
    connection.execute(f"SET temp_directory = '{tempfile.mkdtemp(prefix='compare-')}'")
    connection.execute("SET max_temp_directory_size = '5GB'")
    connection.execute("SET memory_limit = '8GB'")
    for file in sorted(Path(folder).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def normal(columns: list[str], rows: list) -> list:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(row[i] for i in order) for row in rows), key=repr)


def same(left, right) -> bool:
    if isinstance(left, float) or isinstance(right, float):
        return left is not None and right is not None and float(left) == float(right)
    return left == right


def difference(spark, connection, folder: str, name: str) -> str | None:
    """None where both sides agree, else what differs."""
    df = contract.queries()[name](spark, folder)
    spark_rows = [tuple(row) for row in df.collect()]
    sql = contract.oracle_sql().get(name)
    if sql is None:
        return None if spark_rows else "no rows"
    cursor = connection.execute(sql)
    columns = [item[0] for item in cursor.description]
    if sorted(columns) != sorted(df.columns):
        return f"columns {sorted(df.columns)} against {sorted(columns)}"
    left, right = normal(df.columns, spark_rows), normal(columns, cursor.fetchall())
    if len(left) != len(right):
        return f"{len(left)} rows against {len(right)}: {left[:2]} {right[:2]}"
    wrong = [(a, b) for a, b in zip(left, right) if not all(map(same, a, b))]
    return f"{len(wrong)} of {len(left)} rows: {wrong[:3]}" if wrong else None


if __name__ == "__main__":
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(contract.queries())
    session = build_session("compare", "local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false", spark__driver__memory="16g")
    session.sparkContext.setLogLevel("ERROR")
    database = connect(folder)
    for name in names:
        start = time.time()
        try:
            result = difference(session, database, folder, name)
        except Exception as error:  # report and go on with the next query
            result = f"{type(error).__name__}: {str(error)[:600]}"
        print(f"{'ok  ' if result is None else 'FAIL'} {name} {time.time() - start:.1f}s {result or ''}", flush=True)
