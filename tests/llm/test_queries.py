"""The named queries on the smallest tables: result columns, whole tables, and the check SQL where there is one."""

import duckdb
import pytest

from creditlake.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
COLUMNS = {
    "op1_passages": ["doc_id", "source_id"], "op2_secrets": ["doc_id", "start", "end", "is_secret"], "op3_language": ["doc_id", "held_out", "lang_pred", "score"],
    "op4_licenses": ["doc_id", "family"], "op5_token_files": ["doc_id", "start", "n_tokens", "ids_crc32"],
    "op6_superminhash": ["doc_id", "n_shingles", "component_id", "kept"], "op7_quality": ["doc_id", "held_out", "score", "predicted"],
    "op8_topk": ["query_id", "rank", "vec_id", "score"], "op9_decontaminate": ["doc_id", "item_id"],
    "op10_bpe": ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"], "op12_packing": ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"], 
    "op11_runs": ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"],
    "op13_alignment": ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"], "pipeline": ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
}
ALL_DOCUMENTS = ("op3_language", "op5_token_files", "op6_superminhash", "op7_quality", "op10_bpe", "op11_runs", "op13_alignment")


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, name):
    df = QUERIES[name](spark, SF)
    assert set(COLUMNS[name]) <= set(df.columns)
    rows = df.collect()
    if name in ALL_DOCUMENTS:
        assert sorted(r.doc_id for r in rows) == sorted(r.doc_id for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id").collect())
    if name in ORACLES:
        con = duckdb.connect()
        con.execute(f"create view embeddings as select * from '{SF}/embeddings.parquet'")
        want = con.execute(ORACLES[name]).fetchall()
        assert sorted(map(tuple, rows)) == sorted(want)
