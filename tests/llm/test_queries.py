"""Every query of the training-data operators over the smallest tables; those that SQL can state against their SQL."""

import os

import duckdb
import pytest

from kartoteka.llm import queries

DATA = "/root/testdata/sf0.001"
COLUMNS = {
    "p1_found": "first_id id", "p2_found": "id kind", "p3_found": "id_a id_b", "p4_found": "id field", "p5_found": "group_id field person_id", "p6_found": "id place_id",
    "p9_found": "doc_id kind start_pos", "p2_repaired": "id text", "p9_redacted": "doc_id text", "p3_classes": "id class_id", "p6_misses": "value n",
}
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="needs the test tables")


@pytest.fixture(scope="module")
def tables():
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for f in os.listdir(DATA):
        con.execute(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM read_parquet('{DATA}/{f}')")
    return con


@pytest.mark.parametrize("name", list(queries.QUERIES))
def test_query(spark, tables, name):
    df = queries.QUERIES[name](spark, DATA)
    rows = [tuple(r) for r in df.collect()]
    assert len(set(map(str, rows))) == len(rows) > 0 or name == "p7_containers"
    if name in COLUMNS:
        assert df.columns == COLUMNS[name].split()
    if name in ("p2_repaired", "p9_redacted"):
        table = "life_events" if name == "p2_repaired" else "documents"
        assert len(rows) == tables.execute(f"SELECT count(*) FROM {table}").fetchone()[0]
    if name in queries.ORACLES:
        assert sorted(rows) == sorted(tables.execute(f"SELECT {', '.join(df.columns)} FROM ({queries.ORACLES[name]})").fetchall())
