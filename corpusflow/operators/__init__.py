"""Relational operators: ordering, mixing, tokens, packing, preparation, evaluation, monitoring, cost."""
