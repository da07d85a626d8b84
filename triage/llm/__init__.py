"""Operators of a training-data pipeline over tables of documents and pages.

One module for each operator (``quality_fm``, ``langid``, ``pii``,
``token_orc``, ``jaccard_join``, ``toxicity``, ``rule_forest``,
``decontaminate``, ``warc_zstd``, ``mixing``); ``queries`` registers the ten
``opN_*`` queries and ``pipeline``. Nothing outside this subpackage imports it.
"""
