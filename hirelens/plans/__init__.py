"""Query plans: analysis/audit operators and the registered query modules."""
from hirelens.plans import q_analysis, q_clean, q_fuzzy, q_io, q_stream, q_taxonomy, q_text  # noqa: F401
