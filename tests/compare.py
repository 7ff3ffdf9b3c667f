"""Order-insensitive comparison of results."""

from __future__ import annotations

from collections import Counter


def multiset(columns, rows) -> tuple[list[str], Counter]:
    """Sorted column names, and the rows with their values in that order."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return (
        [columns[i] for i in order],
        Counter(tuple(row[i] for i in order) for row in rows),
    )


def spark_rows(frame):
    return multiset(frame.columns, frame.collect())


def duck_rows(connection, sql):
    cursor = connection.execute(sql)
    return multiset([d[0] for d in cursor.description], cursor.fetchall())
