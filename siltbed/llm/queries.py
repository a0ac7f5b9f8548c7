"""The named queries of this package and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from siltbed.llm import decontaminate, fingerprints, lexical, lm, neardup, packing, pii, quality, secrets, substrings, tokenfiles, toxicity, trie

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_lm_scores": lm.op1_lm_scores,
    "op2_packing": packing.op2_packing,
    "op3_fingerprints": fingerprints.op3_fingerprints,
    "op4_token_files": tokenfiles.op4_token_files,
    "op5_near_duplicates": neardup.op5_near_duplicates,
    "op6_toxicity": toxicity.op6_toxicity,
    "op7_pii": pii.op7_pii,
    "op8_decontamination": decontaminate.op8_decontamination,
    "op9_quality": quality.op9_quality,
    "op10_secrets": secrets.op10_secrets,
    "op11_conversation_trie": trie.op11_conversation_trie,
    "op12_substrings": substrings.op12_substrings,
    "op13_lexical_search": lexical.op13_lexical_search,
}

#: The first ten return what SQL cannot express (learned scores, sketches, tokenizers, packing), so tests
#: hold each against a brute-force version, a round trip or held-out labels.
ORACLES: dict[str, str] = {
    "op11_conversation_trie": trie.OP11_SQL,
    "op12_substrings": substrings.OP12_SQL,
    "op13_lexical_search": lexical.OP13_SQL,
}
