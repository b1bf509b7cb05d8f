"""Operators for training-data pipelines over documents and web pages."""

from importlib import import_module

_QUERIES = (
    "q_exact_dedup", "q_token_blocks", "q_chunk_bpe", "q_line_dedup", "q_ngram_join", "q_decontaminate", "q_language_id",
    "q_warc", "q_license_scan", "q_ngram_trie", "q_packing", "q_repair", "q_whitening",
)


def load():
    """Import every module that registers queries and return the registry."""
    for name in _QUERIES:
        import_module(f"gleanstar.llm.{name}")
    return import_module("gleanstar.llm.registry")
