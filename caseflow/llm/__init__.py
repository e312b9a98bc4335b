"""Training-data operators (ten numbered operators and their queries).

Nothing else in the library imports this subpackage.
"""
