"""Operators for preparing training corpora.

One module per operator; each has a general function over DataFrames and a thin
``opN_<name>`` query in :mod:`stratum.llm.catalog` that runs it over its whole
table. Nothing else in the package imports this subpackage.
"""
