"""The registered queries of this package and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from stargauge.llm.byte_bpe import op12_byte_bpe
from stargauge.llm.byte_cnn import op9_quality_classifier
from stargauge.llm.html_text import op6_html_extraction
from stargauge.llm.imatch import op7_imatch
from stargauge.llm.language_id import op4_language_id
from stargauge.llm.license_scan import op5_license_scan, oracle_sql as op5_sql
from stargauge.llm.packing import op1_packing
from stargauge.llm.pitman_yor import op3_lm_scoring
from stargauge.llm.prefix_trie import op11_prefix_trie
from stargauge.llm.quality_rules import OP8_SQL, op8_quality_rules
from stargauge.llm.sentence_pieces import op2_sentence_pieces
from stargauge.llm.simhash import op10_simhash
from stargauge.llm.spelling import op13_spelling

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_packing": op1_packing,
    "op2_sentence_pieces": op2_sentence_pieces,
    "op3_lm_scoring": op3_lm_scoring,
    "op4_language_id": op4_language_id,
    "op5_license_scan": op5_license_scan,
    "op6_html_extraction": op6_html_extraction,
    "op7_imatch": op7_imatch,
    "op8_quality_rules": op8_quality_rules,
    "op9_quality_classifier": op9_quality_classifier,
    "op10_simhash": op10_simhash,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_byte_bpe": op12_byte_bpe,
    "op13_spelling": op13_spelling,
}

ORACLES: dict[str, str] = {"op5_license_scan": op5_sql(), "op8_quality_rules": OP8_SQL}
