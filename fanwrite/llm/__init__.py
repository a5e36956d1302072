"""Operations for preparing language-model training data.

One module per operator; ``catalog`` registers a query for each.  Nothing
outside this package imports it, and it may be removed as a whole.
"""
