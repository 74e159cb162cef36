"""Spark and DuckDB side by side."""

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def norm(v):
    if isinstance(v, float):
        return "nan" if v != v else repr(round(v, 6) + 0.0)
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(map(norm, v)) + "]"
    return str(v)


def duck(data, sql):
    c = duckdb.connect()
    c.execute("SET timezone = 'UTC'")
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{data}/{t}.parquet')")
    r = c.execute(sql)
    names = [x[0] for x in r.description]
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(names), sorted(tuple(norm(row[i]) for i in order) for row in r.fetchall())


def spark_rows(df):
    names = sorted(df.columns)
    return names, sorted(tuple(norm(v) for v in r) for r in df.select(*names).collect())
