"""Operators that prepare training data for language models: scans, scores, links, formats and packing of texts.

Nothing outside this folder, ``tests/llm`` and ``corpus_pipeline.py`` imports it.
"""
