import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
CHECKED = [
    "delivered_messages", "tolerant_json", "templates", "page_templates", "template_frequency", "rule_classification", "label_report",
    "resolve_votes", "upsert_first_wins", "phone_categories", "score_documents_flat", "near_templates",
]


@pytest.fixture(scope="module")
def duck(data):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{data}/{t}.parquet'")
    return con


def ordered(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(repr(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", CHECKED)
def test_matches_sql(spark, duck, data, name):
    df = queries()[name](spark, data)
    cur = duck.execute(oracle_sql()[name])
    cols = [c[0] for c in cur.description]
    assert sorted(cols) == sorted(df.columns)
    assert ordered(df.columns, df.collect()) == ordered(cols, cur.fetchall())


def test_registry():
    assert set(oracle_sql()) <= set(queries())


def test_entry(spark):
    assert entry(spark).count() > 0
