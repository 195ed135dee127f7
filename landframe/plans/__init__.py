"""Query plans: library pipelines (L1-L12), stand-in inputs and the query registry."""

from landframe.plans.registry import ORACLE, QUERIES  # noqa: F401


def load_all() -> None:
    """Import every module that registers queries."""
    from landframe.plans import q_functions, q_layers, q_pages, q_pipelines, q_relational, q_sources, q_spatial  # noqa: F401
