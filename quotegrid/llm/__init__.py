"""Operators for preparing training text. Nothing outside this package imports it."""


def all_queries():
    from quotegrid.llm import catalog

    return dict(catalog.queries())


def all_oracles():
    from quotegrid.llm import catalog

    return dict(catalog.oracles())
