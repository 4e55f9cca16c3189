"""The library's operators applied to the given tables, each with the equivalent SQL."""


def load():
    """(queries, sql) with every module registered."""
    from workload import q_compare, q_coverage, q_functions, q_gaps, q_jobs, q_pages, q_panel, q_stats, q_trees, q_waterfall  # noqa: F401
    from workload.registry import ORACLE, QUERIES
    return dict(QUERIES), dict(ORACLE)
