"""Column-expression helpers (all built-in Spark functions, no UDF)."""

from termcluster.functions.geometry import (centre_array_sql, centre_distances_sql, nearest_index_sql,
                                            squared_distance, term_index, term_label,
                                            with_nearest_centre)
from termcluster.functions.text import mentioned_terms, mentions, term_array, tokens

__all__ = [
    "centre_array_sql", "centre_distances_sql", "mentioned_terms", "mentions", "nearest_index_sql",
    "squared_distance", "with_nearest_centre",
    "term_array", "term_index", "term_label", "tokens",
]
