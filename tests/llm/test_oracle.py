"""Queries against their DuckDB SQL."""

from __future__ import annotations

import duckdb
import pytest

from emporium.llm.queries import ORACLE, QUERIES


def rounded(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(round(r[i], 9) if isinstance(r[i], float) else r[i] for i in order) for r in rows), key=repr)


@pytest.mark.parametrize("key", sorted(ORACLE))
@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_query_matches_sql(spark, key, sf):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('/root/testdata/{sf}/documents.parquet')")
    df = QUERIES[key](spark, f"/root/testdata/{sf}")
    cur = con.execute(ORACLE[key])
    names = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(names)
    assert rounded([tuple(r) for r in df.collect()], df.columns) == rounded(cur.fetchall(), names)


def test_sql_of_the_battery_agrees_on_planted_secrets(spark, tmp_path):
    """The given tables hold no secret that only the battery finds; these rows do."""
    import random
    import string

    from edge_cases import docs

    from emporium.llm import secrets

    rng = random.Random(8)
    draw = lambda letters, n: "".join(rng.choice(letters) for _ in range(n))
    rows = [(i, f"là {draw(string.ascii_letters + string.digits + '+/', 24 + i % 30)} et {draw('0123456789abcdef', 20 + i % 11)}, token={draw('ABCDEF0123456789', 30)}") for i in range(150)]
    rows += [(1000 + i, f"see this_is_a_long_identifier_v{i} and https/www/example/path{i}/to/file") for i in range(300)] + [(5000, None), (5001, "")]
    df = docs(spark, rows).select("doc_id", "text")
    df.coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    got = secrets.report(df)
    cur = con.execute(ORACLE["op6_secret_scans"])
    names = [d[0] for d in cur.description]
    want = rounded(cur.fetchall(), names)
    assert rounded([tuple(r) for r in got.collect()], got.columns) == want
    assert sum(r[names.index("n_random")] for r in con.execute(ORACLE["op6_secret_scans"]).fetchall()) > 100
