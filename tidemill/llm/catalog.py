"""Registered queries of the training-data operators and their DuckDB SQL."""

from __future__ import annotations

from tidemill.llm.bpe import op2_bpe
from tidemill.llm.fingerprints import op10_fingerprints
from tidemill.llm.language import op6_language
from tidemill.llm.licences import op3_licences
from tidemill.llm.mixing import op9_mix_sources
from tidemill.llm.neardup import op5_neardup
from tidemill.llm.negatives import op12_negatives
from tidemill.llm.oracle import ORACLE
from tidemill.llm.pieces import op13_pieces
from tidemill.llm.quality import op7_quality
from tidemill.llm.ranking import op11_search
from tidemill.llm.rules import op1_rules
from tidemill.llm.substrings import op8_substrings
from tidemill.llm.urls import op4_urls

QUERIES = {
    "op1_rules": op1_rules,
    "op2_bpe": op2_bpe,
    "op3_licences": op3_licences,
    "op4_urls": op4_urls,
    "op5_neardup": op5_neardup,
    "op6_language": op6_language,
    "op7_quality": op7_quality,
    "op8_substrings": op8_substrings,
    "op9_mix_sources": op9_mix_sources,
    "op10_fingerprints": op10_fingerprints,
    "op11_search": op11_search,
    "op12_negatives": op12_negatives,
    "op13_pieces": op13_pieces,
}

__all__ = ["ORACLE", "QUERIES"]
