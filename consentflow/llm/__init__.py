"""Training-data operators: scans, filters, deduplication, tokenisation, scoring.

Each module holds one operator with a general interface; ``queries`` registers
one query per operator. Nothing outside this folder (and ``corpus_pipeline``)
imports it.
"""
