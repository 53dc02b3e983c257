"""Column expressions and row filters."""

from scholarmetrics.functions.expressions import (
    hash_bucket,
    histogram_bucket,
    l2_normalized,
    position_credit,
    venue_key,
)
from scholarmetrics.functions.predicates import (
    below_cap,
    cited_only,
    fields_named,
    keywords_in_field,
    leading_authors,
    min_count,
    non_blank,
    papers_newer_than,
    papers_of_year,
    positive_weights,
    year_gap,
)

__all__ = [
    "below_cap",
    "cited_only",
    "fields_named",
    "hash_bucket",
    "histogram_bucket",
    "keywords_in_field",
    "l2_normalized",
    "leading_authors",
    "min_count",
    "non_blank",
    "papers_newer_than",
    "papers_of_year",
    "position_credit",
    "positive_weights",
    "venue_key",
    "year_gap",
]
