"""Training-data operators over document, label and embedding tables.

Nothing else in the library imports this subpackage. One module per operator
(its general interface and real outputs), :mod:`fieldmart.llm.queries` with the
registered ``opN_`` queries and :mod:`fieldmart.llm.oracle` with their SQL.
"""
