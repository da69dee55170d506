"""The queries of this subpackage; none has SQL: see the tests for what each is held against."""

from __future__ import annotations

from tidemark.llm.bpe import op6_bpe
from tidemark.llm.chat import op4_chat
from tidemark.llm.context_tree import op7_context_tree
from tidemark.llm.embeddings import op5_embeddings
from tidemark.llm.fingerprints import op9_fingerprints
from tidemark.llm.jaccard import op3_jaccard
from tidemark.llm.language import op1_language
from tidemark.llm.licenses import op10_licenses
from tidemark.llm.packing import op8_packing
from tidemark.llm.toxicity import op2_toxicity

QUERIES = {
    "op1_language": op1_language,
    "op2_toxicity": op2_toxicity,
    "op3_jaccard": op3_jaccard,
    "op4_chat": op4_chat,
    "op5_embeddings": op5_embeddings,
    "op6_bpe": op6_bpe,
    "op7_context_tree": op7_context_tree,
    "op8_packing": op8_packing,
    "op9_fingerprints": op9_fingerprints,
    "op10_licenses": op10_licenses,
}

ORACLES: dict[str, str] = {}
