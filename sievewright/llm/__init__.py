"""Training-data operators: each module is one operator, its query and its SQL if SQL can express it.

Nothing outside this subpackage imports it.
"""
