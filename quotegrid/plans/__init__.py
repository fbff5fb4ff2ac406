"""Registered queries over the test tables."""


def _load():
    from quotegrid.plans import catalog, grid_queries, model_queries, stream_queries, table_queries  # noqa: F401

    return catalog


def all_queries():
    return dict(_load().QUERIES)


def all_oracles():
    return dict(_load().ORACLES)
