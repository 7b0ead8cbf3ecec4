"""The registered corpus queries: those with SQL against it, all of them by their columns, over the smallest tables."""

from pathlib import Path

import duckdb
import pytest

from driftwright.llm import queries

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="no driver tables here")
COLUMNS = {
    "op1_substring_dedup": ["doc_id", "start", "stop", "n_words", "kept_in"], "op2_license_scan": ["doc_id", "licenses"], "op3_byte_bpe": ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
    "op4_exact_top_k": ["query_id", "rank", "vec_id", "score"], "op5_near_duplicates": ["doc_id", "n_shingles", "component_id", "kept"], "op6_html_extraction": ["page_id", "url", "text", "n_chars"],
    "op7_toxicity": ["doc_id", "held_out", "score", "predicted"], "op8_decontamination": ["doc_id", "item_id"], "op9_secret_scan": ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"],
    "op10_language_id": ["doc_id", "held_out", "lang_pred", "score"], "op12_simhash": ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
}


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_columns_and_rows(spark, name):
    found = queries.QUERIES[name](spark, FOLDER)
    assert found.columns[: len(COLUMNS[name])] == COLUMNS[name] or set(COLUMNS[name]) <= set(found.columns)
    rows = [r.asDict() for r in found.collect()]
    if name in queries.ORACLES:
        connection = duckdb.connect()
        for file in Path(FOLDER).glob("*.parquet"):
            connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
        expected = connection.execute(queries.ORACLES[name])
        names = [c[0] for c in expected.description]
        assert sorted(names) == sorted(found.columns)
        assert sorted(map(str, expected.fetchall())) == sorted(str(tuple(r[c] for c in names)) for r in rows)
    elif name not in ("op1_substring_dedup", "op6_html_extraction"):
        assert len(rows) == spark.read.parquet(f"{FOLDER}/documents.parquet").count()
