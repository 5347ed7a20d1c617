"""Registered queries of this subpackage and their SQL twins."""

from __future__ import annotations

from .byte_bpe import op10_byte_bpe
from .conversations import OP12_SQL, op12_conversation_repair
from .embedding_dedup import op2_embedding_near_dedup
from .fill_in_middle import OP13_SQL, op13_fill_in_middle
from .fingerprint import op1_document_fingerprints
from .html_text import op7_html_extraction
from .language_id import op5_language_id
from .line_dedup import OP6_SQL, op6_line_dedup
from .mixing import OP4_SQL, op4_mixing_sources
from .quality import OP11_SQL, op11_quality_rules
from .secrets import op3_secret_scan
from .simhash_dedup import op9_simhash_near_dedup
from .toxicity import op8_toxicity

QUERIES = {f.__name__: f for f in (
    op1_document_fingerprints, op2_embedding_near_dedup, op3_secret_scan, op4_mixing_sources, op5_language_id,
    op6_line_dedup, op7_html_extraction, op8_toxicity, op9_simhash_near_dedup, op10_byte_bpe,
    op11_quality_rules, op12_conversation_repair, op13_fill_in_middle,
)}

SQL = {
    "op4_mixing_sources": OP4_SQL, "op6_line_dedup": OP6_SQL, "op11_quality_rules": OP11_SQL, "op12_conversation_repair": OP12_SQL,
    "op13_fill_in_middle": OP13_SQL,
}
