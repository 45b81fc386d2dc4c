import re

import duckdb
import pandas as pd

from glossa.llm import queries


def oracle(name, sf_dir, tables=("documents", "benchmark", "conversations", "pages", "embeddings", "labels")):
    con = duckdb.connect()
    for t in tables:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con.execute(queries.oracle_sql()[name]).df()


def same(got: pd.DataFrame, want: pd.DataFrame) -> None:
    columns = sorted(want.columns)
    assert sorted(got.columns) == columns
    rows = lambda f: sorted(map(repr, f[columns].astype(object).where(f[columns].notna(), None).itertuples(index=False, name=None)))
    assert rows(got) == rows(want)


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
