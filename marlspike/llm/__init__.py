"""Operators that prepare training text at corpus scale.

Every operator takes and returns DataFrames, never brings a corpus-sized object to the
driver, and has a thin ``opN_<name>`` query in :mod:`marlspike.llm.registry`.  Nothing
outside this subpackage imports it.
"""
