"""Training-data operators: extraction, de-duplication, packing, tokenisation, filtering.

Nothing else in the library imports this subpackage.  Each ``opN_*`` module holds
one operator (general interface, real outputs) and ``queries.py`` registers the
thin query over the benchmark tables.
"""
