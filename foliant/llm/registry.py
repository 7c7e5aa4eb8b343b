"""Queries of the training-data operators, and their SQL where SQL can express them."""
from __future__ import annotations

from foliant.llm import collocations, filter_audit, quality_rules, secrets, substrings, warc
from foliant.llm.byte_bpe import op3_byte_bpe
from foliant.llm.collocations import op13_collocations
from foliant.llm.filter_audit import op11_filter_audit
from foliant.llm.language_id import op1_language_id
from foliant.llm.mixing import op6_mixing
from foliant.llm.nearest import op2_nearest
from foliant.llm.pii import op8_pii
from foliant.llm.quality_classifier import op4_quality_classifier
from foliant.llm.quality_rules import op5_quality_rules
from foliant.llm.secrets import op7_secrets
from foliant.llm.simhash import op9_simhash_dedup
from foliant.llm.substrings import op12_substring_dedup
from foliant.llm.warc import op10_warc

QUERIES = {
    f.__name__: f
    for f in (
        op1_language_id,
        op2_nearest,
        op3_byte_bpe,
        op4_quality_classifier,
        op5_quality_rules,
        op6_mixing,
        op7_secrets,
        op8_pii,
        op9_simhash_dedup,
        op10_warc,
        op11_filter_audit,
        op12_substring_dedup,
        op13_collocations,
    )
}

#: SQL has no classifier, encoder, quantiser or XXH64, and no loop for PII's rounds: tests hold those to brute force.
ORACLES: dict[str, str] = {"op5_quality_rules": quality_rules.ORACLE_SQL, "op7_secrets": secrets.ORACLE_SQL, "op10_warc": warc.ORACLE_SQL, "op11_filter_audit": filter_audit.ORACLE_SQL, "op12_substring_dedup": substrings.ORACLE_SQL, "op13_collocations": collocations.ORACLE_SQL}
