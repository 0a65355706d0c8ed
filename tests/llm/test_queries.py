"""The registered queries on the smallest tables, against SQL or brute force over the whole table."""

import os

import pyarrow.parquet as pq
import pytest

from refillcast.llm.queries import ORACLES, QUERIES

from . import test_repeats, test_rules, test_secrets
from .brute import brute_components, brute_fingerprint

duckdb = pytest.importorskip("duckdb")
DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="test tables are not here")


@pytest.fixture(scope="module")
def texts():
    table = pq.read_table(f"{DATA}/documents.parquet")
    return dict(zip(table.column("doc_id").to_pylist(), table.column("text").to_pylist()))


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "conversations", "labels", "benchmark", "pages", "embeddings"):
        con.execute(f"create view {table} as select * from '{DATA}/{table}.parquet'")
    cursor = con.execute(ORACLES[name])
    columns = [d[0] for d in cursor.description]
    df = QUERIES[name](spark, DATA)
    assert sorted(df.columns) == sorted(columns)
    assert sorted(map(tuple, df.select(*columns).collect())) == sorted(cursor.fetchall())


def test_op4(spark, texts):
    ids = sorted(texts)
    fps = [brute_fingerprint(texts[i]) for i in ids]
    want = [(i, f"{f:016x}", c) for i, f, c in zip(ids, fps, brute_components(fps, ids))]
    got = QUERIES["op4_pivot_simhash"](spark, DATA).select("doc_id", "fingerprint", "component_id").collect()
    assert sorted(map(tuple, got)) == want


def test_op5(spark, texts):
    got = QUERIES["op5_vector_packing"](spark, DATA).collect()
    assert sorted(r["doc_id"] for r in got) == sorted(texts)
    sizes = [sum(r["size"] for r in got if r["shard"] == s) for s in range(24)]
    assert max(sizes) - min(sizes) <= max(r["size"] for r in got)


def test_op7(spark, texts):
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    got = QUERIES["op7_decision_list"](spark, DATA).collect()
    assert {r["doc_id"]: tuple(r[n] for n in names) for r in got} == {i: test_rules.brute(t) for i, t in texts.items()}
    assert not any(r["kept"] and r["base_failed"] for r in got)


def test_op8(spark, texts):
    got = QUERIES["op8_inferred_grammars"](spark, DATA).collect()
    for r in got:
        assert (r["n_assign"], r["n_access"], r["n_hex"]) == tuple(
            sum(k == x for _, k, _ in test_secrets.brute(texts[r["doc_id"]])) for x in range(3))
    assert len(got) == len(texts)


def test_op10(spark, texts):
    got = QUERIES["op10_suffix_repeats"](spark, DATA).collect()
    assert sorted((tuple(r) for r in got), key=str) == test_repeats.brute(list(texts.items()), 50)


@pytest.mark.parametrize("name", ["op1_soft_mixing", "op2_seeded_alignment", "op6_classifier_chain", "op9_host_paths"])
def test_other_queries_give_rows(spark, name):
    assert not QUERIES[name](spark, DATA).isEmpty()
