"""The queries of this subpackage, for the driver contract."""

from __future__ import annotations

import sys
from pathlib import Path

from . import byte_bpe, decontaminate, filter_audit, html_text, language_id, line_dedup, minhash, packing, secret_scan, sharding, suffix_dedup, threshold_search, word_runs


def _pipeline(spark, sf_dir):
    top = str(Path(__file__).resolve().parents[2])
    if top not in sys.path:
        sys.path.insert(0, top)
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {
    "op1_line_dedup": line_dedup.query,
    "op2_byte_bpe": byte_bpe.query,
    "op3_html_text": html_text.query,
    "op4_secret_scan": secret_scan.query,
    "op5_suffix_dedup": suffix_dedup.query,
    "op6_decontaminate": decontaminate.query,
    "op7_language_id": language_id.query,
    "op8_threshold_search": threshold_search.query,
    "op9_minhash": minhash.query,
    "op10_hilbert_shards": sharding.query,
    "op11_filter_audit": filter_audit.query,
    "op12_best_two_fit": packing.query,
    "op13_word_runs": word_runs.query,
    "pipeline": _pipeline,
}

SQL = {"op1_line_dedup": line_dedup.SQL, "op8_threshold_search": threshold_search.SQL, "op11_filter_audit": filter_audit.SQL}
