"""Row sets of two engines, compared value by value."""

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def oracle_rows(sf_dir, sql):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    cursor = connection.execute(sql)
    names = [c[0] for c in cursor.description]
    return names, cursor.fetchall()


def normal(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(repr(tuple(row[i] for i in order)) for row in rows)


def assert_same(df, sf_dir, sql):
    names, rows = oracle_rows(sf_dir, sql)
    assert sorted(df.columns) == sorted(names)
    got = [tuple(r) for r in df.collect()]
    assert len(got) == len(rows)
    assert normal(df.columns, got) == normal(names, rows)
