"""Training-data operators: text, token, vector and archive jobs over document tables.

Nothing else in the library imports this subpackage.  Each module holds one operator with
its own general interface; ``queries`` holds the registered ``opN_*`` queries, which only
derive digest columns from what the operators return.
"""
