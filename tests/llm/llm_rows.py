"""Rows of Spark and DuckDB results, compared as multisets with nulls."""


def rows(df):
    names = sorted(df.columns)
    return sorted(map(repr, (tuple(r[c] for c in names) for r in df.collect())))


def sql_rows(con, sql, names):
    return sorted(map(repr, con.sql(f"SELECT {', '.join(sorted(names))} FROM ({sql})").fetchall()))
