"""Operators for large training corpora, and the queries that apply them.

Nothing outside this subpackage imports it. Modules: one per operator, plus
``arrays`` (vectorised text handling inside tasks), ``frames`` (row keys, scratch
tables), ``components`` (connected components) and ``queries`` (registered queries).
"""
