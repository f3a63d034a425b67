"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from trawl.llm import sql
from trawl.llm.decontamination import op4_decontamination
from trawl.llm.html_text import op2_html_text
from trawl.llm.language import op1_language
from trawl.llm.licenses import op11_licenses
from trawl.llm.manifest import op13_manifest
from trawl.llm.near_duplicates import op10_near_duplicates
from trawl.llm.neighbours import op9_neighbours
from trawl.llm.packing import op5_packing
from trawl.llm.repeats import op6_substring_dedup
from trawl.llm.secrets import op7_secrets
from trawl.llm.spelling import op12_spelling
from trawl.llm.token_counts import op3_token_counts
from trawl.llm.toxicity import op8_toxicity

REGISTERED = [op1_language, op2_html_text, op3_token_counts, op4_decontamination, op5_packing,
              op6_substring_dedup, op7_secrets, op8_toxicity, op9_neighbours, op10_near_duplicates,
              op11_licenses, op12_spelling, op13_manifest]

QUERIES = {f.__name__: f for f in REGISTERED}
#: The others apply a trained model or a tokenizer, need exact floating-point order or give places of pattern
#: matches, which SQL cannot express; tests compare them with brute force.
ORACLE_SQL: dict[str, str] = {
    "op4_decontamination": sql.DECONTAMINATION,
    "op6_substring_dedup": sql.REPEATS,
    "op10_near_duplicates": sql.NEAR_DUPLICATES,
    "op11_licenses": sql.LICENSES,
    "op12_spelling": sql.SPELLING,
    "op13_manifest": sql.MANIFEST,
}
