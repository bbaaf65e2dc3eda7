"""Operators for training-data pipelines (deduplication, mixing, packing,
token counts, joins, search, sharding, quality scoring).  Nothing else in the
library imports this subpackage."""
