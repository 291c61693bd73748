"""All registered queries."""

from noticeloom.plans import q_clean, q_curate, q_evaluate, q_load, q_sources, q_spans, q_streams  # noqa: F401
from noticeloom.plans.catalog import ORACLE, QUERIES  # noqa: F401
