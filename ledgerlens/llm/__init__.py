"""Training-data operators: near-dedup, tokenisation, scoring, filtering, sharding.

Nothing outside this subpackage imports it.  Each module holds one operator with its own
general interface; ``queries`` registers the thin ``opN_<name>`` queries over them.
"""
