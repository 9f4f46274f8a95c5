"""DataFrame -> DataFrame operators."""

from aerocorr.operators.clean import (  # noqa: F401
    avg_particulates, canonicalize, complete_cases, daytime_filter, dedupe_by_key,
    distinct_positions, drop_any_missing, keep_if_all_present, keep_if_any_present,
    outlier_filter, unify_families, with_avg_particulates,
)
from aerocorr.operators.joins import join_attributes, key_filter, salted_join, size_checked_broadcast  # noqa: F401
from aerocorr.operators.nearest import (  # noqa: F401
    closest_rows, min_distance, nearest_below, nearest_sites, nearest_within, positions_with_min_distance,
)
from aerocorr.operators.stats import (  # noqa: F401
    co_moments, correlation_matrix, correlation_matrix_ml, grouped_moments, matrix_of_moments, matrix_wide,
    merge_moments, pooled_correlation_matrix,
)
from aerocorr.operators.sampling import exact_sample, random_sample  # noqa: F401
from aerocorr.operators.geocode import (  # noqa: F401
    country_filter, enrich_country, geocode_table, geocode_worklist, parse_responses,
)
