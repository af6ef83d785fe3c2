"""Every core query that has SQL gives what the SQL gives, on the smallest tables."""

import math
from pathlib import Path

import duckdb
import pytest

from testimonia.plans import QUERIES, SQL

DATA = Path("/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def tables():
    con = duckdb.connect()
    for f in DATA.glob("*.parquet"):
        con.sql(f"create view {f.stem} as select * from '{f}'")
    return con


def _plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else f"{v:.9g}"
    return "~" if v is None else str(v)


@pytest.mark.parametrize("name", sorted(SQL))
def test_sql_agrees(spark, tables, name):
    mine, sql = QUERIES[name](spark, str(DATA)), tables.sql(SQL[name])
    columns = sorted(mine.columns)
    assert columns == sorted(sql.columns)
    rows = lambda found: sorted([_plain(v) for v in r] for r in found)
    assert rows(mine.select(*columns).collect()) == rows(sql.select(*[f'"{c}"' for c in columns]).fetchall())


def test_every_query_has_sql_or_a_reason():
    """Queries that SQL cannot say: pieces by sentences, pages of turns, longest matching blocks, label propagation, name-based ids, vectors of bytes."""
    assert sorted(set(QUERIES) - set(SQL)) == ["a16_compared_arm", "f9_point_ids", "g14_communities", "j10_soft_matches", "t3_turn_pages", "t4_split_turns", "v2_hashed_embeddings"]
