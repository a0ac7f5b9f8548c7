"""The named queries of every module."""

from siltbed.plans import checking, learning, registry, relational, scalar, tables, tokens  # noqa: F401


def queries():
    return dict(registry.QUERIES)


def oracles():
    return dict(registry.ORACLES)
