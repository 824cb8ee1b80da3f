"""The registered queries on the smallest tables: those with SQL against it,
the others for their columns and row counts."""

import math
import os

import pytest

from cartwheel.llm.queries import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"
TABLES = "documents embeddings pages benchmark labels conversations".split()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="given tables not present")


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def norm(v):
    return ("nan" if math.isnan(v) else repr(round(v, 6))) if isinstance(v, float) else repr(v)


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_sql(spark, duck, name):
    df = QUERIES[name](spark, SF)
    want = duck.sql(ORACLE_SQL[name])
    cols = sorted(want.columns)
    assert sorted(df.columns) == cols
    at = [want.columns.index(c) for c in cols]
    assert sorted([norm(r[c]) for c in cols] for r in df.collect()) == sorted(
        [norm(r[i]) for i in at] for r in want.fetchall()
    )


COLUMNS = {
    "op3_shortest_pack_first": "doc_id start length ids_crc32 doc_tokens sequence_id offset",
    "op4_secret_scan": "doc_id n_assign n_access n_hex n_random base_sha256 spans",
    "op5_quality_divergence": "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept",
    "op7_sentencepiece_viterbi": "doc_id n_pieces ids_crc32 exact",
    "op8_toxicity_gru": "doc_id held_out score predicted",
    "op9_wrapper_text": "page_id url text n_chars",
}


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_query_has_its_columns_and_all_rows(spark, name):
    df = QUERIES[name](spark, SF).cache()
    assert set(COLUMNS[name].split()) <= set(df.columns)
    key = COLUMNS[name].split()[0]
    source = spark.read.parquet(f"{SF}/{'pages' if key == 'page_id' else 'documents'}.parquet")
    assert df.select(key).distinct().count() == source.select(key).distinct().count()
