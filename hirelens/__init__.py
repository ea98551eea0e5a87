"""hirelens: job-posting analytics on Spark (cleaning, dedup, skill taxonomy, prevalence analyses).

The public API re-exports the main DataFrame -> DataFrame operators; every
operator module is importable without an active Spark session.
"""
__version__ = "0.1.0"

from hirelens.operators.clean import (  # noqa: E402,F401
    filter_geo, filter_roles, filter_years, flag_duplicates, load_clean, tag_postings, unify, union_sources,
)
from hirelens.operators.extract import cooccurrence, extract_skills  # noqa: E402,F401
from hirelens.operators.fuzzy import fuzzy_band, fuzzy_pairs, greedy_clusters, resolve_collisions  # noqa: E402,F401
from hirelens.operators.parse import (  # noqa: E402,F401
    parse_csv_responses, parse_json_responses, parse_yaml_responses,
)
from hirelens.operators.taxonomy import (  # noqa: E402,F401
    alias_conflicts, attach_skills, category_join, map_skills, reverse_lookup, subcategory,
)
from hirelens.schema import UNIFIED_SCHEMA, finalise  # noqa: E402,F401
from hirelens.session import get_session  # noqa: E402,F401
