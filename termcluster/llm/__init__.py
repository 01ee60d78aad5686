"""Operators of a large-scale training-data pipeline.

Nothing else in the library imports this subpackage. Each module holds one
operator; ``catalog`` registers the ``opN_*`` queries and their SQL."""
