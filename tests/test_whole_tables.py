"""Registered queries that read all rows of their tables, against DuckDB."""

from collections import Counter

import duckdb
import pyarrow as pa
import pyarrow.parquet as pq

import __spark_entry__ as entry

SF_DIR = "/root/testdata/sf0.001"


def rows(spark, name, *tables, sf_dir=SF_DIR):
    """Rows of a query and of its SQL, as bags."""
    with duckdb.connect() as db:
        for t in tables:
            db.sql(f"create view {t} as from read_parquet('{sf_dir}/{t}.parquet')")
        expected = Counter(db.sql(entry.oracle_sql()[name]).fetchall())
    return Counter(tuple(r) for r in entry.queries()[name](spark, sf_dir).collect()), expected


def test_all_of_lineitem_is_melted(spark):
    got, expected = rows(spark, "unpivot_metrics", "lineitem")
    assert got == expected
    assert got.total() == 3 * spark.read.parquet(f"{SF_DIR}/lineitem.parquet").count()


def test_conversations_are_scanned(spark, tmp_path):
    texts = ["call 123456789012, or 123456789012.", "me@example.org and you@example.org", "1234567890123 is too long", None, "no data"]
    pq.write_table(pa.table({"conv_id": [1, 1, 2, 3, 4], "turn": [0, 1, 0, 0, 0], "role": ["user"] * 5, "text": texts}), f"{tmp_path}/conversations.parquet")
    got, expected = rows(spark, "pii_scan_conversations", "conversations", sf_dir=tmp_path)
    assert got == expected == Counter([(1, 0, 1, 0), (1, 1, 0, 2)])
