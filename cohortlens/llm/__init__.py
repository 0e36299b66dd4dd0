"""Operators for preparing large text corpora, with their queries."""

from __future__ import annotations

import sys

from pyspark import cloudpickle

from . import bucket_refinement, common, compression_quality, content_sort, conversation_repair, feistel_pii, learning, negative_mining, piece_merge, pitman_yor, rule_cascade, simhash_vp, stock_packing, token_transducer, toxic_grammar

_MODULES = (piece_merge, feistel_pii, rule_cascade, toxic_grammar, compression_quality, content_sort, stock_packing, pitman_yor, simhash_vp, bucket_refinement, conversation_repair, negative_mining, token_transducer)

# Workers get the functions by value: they need not have the package on their path.
for _module in (common, learning, *_MODULES):
    cloudpickle.register_pickle_by_value(sys.modules[_module.__name__])

QUERIES = {name: run for module in _MODULES for name, run in module.QUERIES.items()}
ORACLES = {name: sql for module in _MODULES for name, sql in module.ORACLES.items()}
