"""Registered queries against their SQL, and the pipeline against brute force, on the smallest tables."""

import duckdb
import pytest

from acreledger.llm.oracle import oracles
from acreledger.llm.queries import REGISTRY
from checks.compare import canonical

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(oracles()))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "pages", "benchmark", "labels", "embeddings"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    df = REGISTRY[name](spark, FOLDER)
    cursor = con.execute(oracles()[name])
    names = [c[0] for c in cursor.description]
    assert sorted(names) == sorted(df.columns)
    assert canonical([tuple(r) for r in df.collect()], df.columns) == canonical(cursor.fetchall(), names)


def test_every_operator_has_a_query():
    assert sorted(int(n[2:].split("_")[0]) for n in REGISTRY) == list(range(1, 14))


def test_pipeline_stages(spark):
    import corpus_pipeline as c

    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    clean = {r[0] for r in c.drop_toxic(spark, docs, FOLDER).collect()}
    labelled = {r[0]: r[1] for r in spark.read.parquet(f"{FOLDER}/labels.parquet").select("doc_id", "toxic").collect()}
    gone = {r[0] for r in docs.collect()} - clean
    assert gone and len(clean) > 0.8 * docs.count() and not any(labelled.get(k) == 0 for k in gone)
    kept = c.drop_near_copies(spark, docs, FOLDER)
    groups = REGISTRY["op10_simhash"](spark, FOLDER)
    assert kept.columns == docs.columns and {r["doc_id"] for r in kept.collect()} == {r["component_id"] for r in groups.collect()}
    free = {r[0] for r in c.drop_contaminated(spark, docs, FOLDER).collect()}
    marked = REGISTRY["op9_decontamination"](spark, FOLDER)
    assert free == {r["doc_id"] for r in marked.filter("NOT contaminated").collect()}
    out = c.run(spark, FOLDER)
    assert set(docs.columns) < set(out.columns) and out.count() > 0
    assert {r["doc_id"] for r in out.collect()} <= clean


def test_pipeline_takes_awkward_and_empty_rows(spark):
    import corpus_pipeline as c

    from .helpers import ROWS, awkward, empty

    docs = awkward(spark, clashes=True).selectExpr("*", "1 AS contaminated", "'own' AS own_1", "'own' AS _doc")
    for rows in (docs, empty(spark)):
        kept = rows
        for name, stage in c.STAGES:
            found = stage(spark, kept, FOLDER)
            if name != "sharding":
                assert found.columns == kept.columns, name
            kept = found
        left = kept.collect()
        assert all(r["own_1"] == "own" and r["_doc"] == "own" for r in left) if rows is docs else not left
    assert {r[0] for r in c.drop_toxic(spark, docs, FOLDER).collect()} <= {r[0] for r in ROWS}
    once = c.drop_near_copies(spark, docs, FOLDER).collect()
    assert sorted(str(r[0]) for r in once) == ["1", "3", "6", "7", "8", "9", "None"]
    assert c.drop_contaminated(spark, docs, FOLDER).count() == len(ROWS)
