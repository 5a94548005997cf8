"""Training-data operators: search, filtering, deduplication, redaction, mixing, tokenising.

Nothing outside this subpackage imports it; ``cartlake.llm.queries`` registers
one thin query per operator and ``corpus_pipeline.py`` chains five of them.
"""
