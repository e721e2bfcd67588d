"""All registered queries; importing a module registers its queries."""

from . import clean_queries, evaluation_queries, feature_queries, model_queries, profile_queries  # noqa: F401
from .registry import ORACLE, QUERIES  # noqa: F401
