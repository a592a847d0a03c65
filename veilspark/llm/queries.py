"""The registered queries of this package: (spark, sf_dir) -> DataFrame, and their SQL."""

from __future__ import annotations

from veilspark.llm.covertree import OP2_SQL, op2_embedding_links
from veilspark.llm.langid import op5_language_id
from veilspark.llm.lines import OP1_SQL, op1_line_dedup
from veilspark.llm.merkle import OP13_SQL, op13_merkle_manifest
from veilspark.llm.mixing import OP3_SQL, op3_mixing
from veilspark.llm.packing import op6_packing
from veilspark.llm.packs import op11_packing
from veilspark.llm.secrets import op7_secret_scan
from veilspark.llm.simhash import op8_simhash
from veilspark.llm.substrings import op9_substring_dedup
from veilspark.llm.treap import OP12_SQL, op12_lexical_search
from veilspark.llm.urls import op10_url_filter
from veilspark.llm.vafile import OP4_SQL, op4_topk_search

QUERIES = {
    "op1_line_dedup": op1_line_dedup,
    "op2_embedding_links": op2_embedding_links,
    "op3_mixing": op3_mixing,
    "op4_topk_search": op4_topk_search,
    "op5_language_id": op5_language_id,
    "op6_packing": op6_packing,
    "op7_secret_scan": op7_secret_scan,
    "op8_simhash": op8_simhash,
    "op9_substring_dedup": op9_substring_dedup,
    "op10_url_filter": op10_url_filter,
    "op11_packing": op11_packing,
    "op12_lexical_search": op12_lexical_search,
    "op13_merkle_manifest": op13_merkle_manifest,
}

#: Where SQL can express the operator; the others are tested against brute force in tests/llm.
ORACLES = {
    "op1_line_dedup": OP1_SQL,
    "op2_embedding_links": OP2_SQL,
    "op3_mixing": OP3_SQL,
    "op4_topk_search": OP4_SQL,
    "op12_lexical_search": OP12_SQL,
    "op13_merkle_manifest": OP13_SQL,
}
