"""Operators of a large-scale training-data pipeline (see README, "Training data").

Each module holds one operator with its own general interface; ``catalog``
registers the ``opN_*`` queries over the benchmark tables, ``sql`` their oracle.
Nothing outside this subpackage imports it.
"""
