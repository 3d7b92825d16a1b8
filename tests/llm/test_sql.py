"""Registered queries against their DuckDB SQL, and the pipeline against a plain statement of its stages."""

import pytest

import corpus_pipeline
from notesmith.llm import byte_bpe, catalog
from notesmith.llm.common import documents
from tests.conftest import SF001
from tests.llm.test_operators import near_by_brute_force
from tools.oracle_check import compare


@pytest.mark.parametrize("name", sorted(catalog.ORACLE))
def test_query_matches_sql(spark, duck, name):
    from tests.conftest import SF01

    assert compare(catalog.QUERIES[name](spark, SF01).toPandas(), duck.execute(catalog.ORACLE[name]).df()) is None


def test_every_operator_has_one_query():
    numbers = sorted(int(n[2:].split("_")[0]) for n in catalog.QUERIES)
    assert numbers == list(range(1, 14))


def test_pipeline_stages(spark):
    import duckdb

    docs = documents(spark, SF001)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF001}/documents.parquet'")
    text = dict(con.execute("SELECT doc_id, text FROM documents").fetchall())
    good = {r[0] for r in con.execute(f"SELECT doc_id FROM ({catalog.ORACLE['op7_quality_rules']}) WHERE kept").fetchall()}
    step = dict(corpus_pipeline.STAGES)
    from notesmith.session import cut_lineage

    a = cut_lineage(step["quality_rules"](spark, docs, SF001))
    ids = lambda df: {r["doc_id"] for r in df.select("doc_id").collect()}
    assert ids(a) == good and a.columns == docs.columns
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    last = {}
    for i in sorted(good):
        last[text[i].translate(low)] = i
    b = cut_lineage(step["exact_dedup"](spark, a, SF001))
    assert ids(b) == set(last.values()) and b.count() == len(last)
    near = near_by_brute_force([(i, text[i]) for i in last.values()])
    c = cut_lineage(step["near_dedup"](spark, b, SF001))
    assert ids(c) == {i for i, (_, comp) in near.items() if i == comp}
    d = cut_lineage(step["source_mix"](spark, c, SF001))
    assert d.columns == docs.columns and ids(d) <= ids(c)
    assert max(r["count"] for r in d.groupBy("doc_id").count().collect()) <= 2
    e = step["byte_bpe"](spark, d, SF001)
    want = {(r["doc_id"], r["n_tokens"]) for r in byte_bpe._digests(d, *byte_bpe.vocabulary(spark)).collect()}
    assert {(r["doc_id"], r["n_tokens"]) for r in e.collect()} == want and e.count() == d.count()
