"""Whole runs (training table, retraining, scoring) and the registered queries."""


def all_queries():
    """Every registered query, by key."""
    from spellcast.plans import (  # noqa: F401
        evaluation_queries,
        feature_queries,
        model_queries,
        quality_queries,
        training_queries,
    )
    from spellcast.plans.registry import QUERIES

    return dict(QUERIES)
