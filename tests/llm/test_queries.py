"""The registered queries on the smallest tables, against their SQL where there is any."""

from pathlib import Path

import duckdb
import pytest

from check import _rows
from logledger.llm.queries import llm_queries, llm_sql

SMALL = "/root/testdata/sf0.001"
TABLES = {"op3_chat": "conversations", "op6_url_filter": "pages", "op9_warc": "pages"}

pytestmark = pytest.mark.skipif(not Path(SMALL).exists(), reason="no test tables")


def test_one_query_for_each_operator():
    numbers = sorted(int(q[2:].split("_")[0]) for q in llm_queries())
    assert numbers == list(range(1, 14)) and set(llm_sql()) <= set(llm_queries())


@pytest.mark.parametrize("name", sorted(llm_queries()))
def test_query(spark, name):
    mine = llm_queries()[name](spark, SMALL).toPandas()
    assert len(mine)
    if name in llm_sql():
        db = duckdb.connect()
        for path in Path(SMALL).glob("*.parquet"):
            db.sql(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
        theirs = db.sql(llm_sql()[name]).df()
        assert sorted(mine.columns) == sorted(theirs.columns)
        assert _rows(mine) == _rows(theirs)
    elif name not in TABLES and name != "op4_packing":
        ids = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id").toPandas()
        assert sorted(mine["doc_id"]) == sorted(ids["doc_id"])
