"""Operators for preparing language-model training data, on Spark DataFrames.

Nothing outside this subpackage imports it. One module per operator; shared
helpers are in ``common`` (tables, shared folder), ``tokens`` (array
tokeniser and fingerprints), ``exchange`` (joining n-gram sets of text chunks
on sorted hash arrays) and ``components`` (connected components).
``queries`` holds the registered queries.
"""
