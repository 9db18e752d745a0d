"""Operators for preparing text corpora, and the queries that apply them.

Nothing else in the package imports this subpackage.  Each module holds one
operator as DataFrame functions; ``registry`` holds the ``opN_*`` queries.

Conventions shared by all operators
* a null text counts as the empty text, a null id stays null;
* rows are told apart by position, not by id: repeated rows give repeated
  results;
* input columns other than the named id and text columns are ignored or
  carried inside a struct, so their names can't clash with working columns;
* an empty table gives an empty result of the same schema.
"""
