"""Operators for training-data pipelines: extraction, language, quality,
deduplication, privacy, mixing, packing, search and archives.

Nothing outside this subpackage imports it; its queries are in
``cardspark.llm.queries``.
"""
