"""Training-data operators: formatting, deduplication, decontamination, search, scans, packing and scoring.

Nothing outside this package imports it.  Every operator is a function over
DataFrames; ``ledgerlight.llm.queries`` registers one query per operator.
"""
