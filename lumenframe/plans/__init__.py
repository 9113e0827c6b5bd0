"""The queries, by topic; importing a module registers its queries."""

from lumenframe.plans.registry import ORACLES, QUERIES


def _load() -> None:
    import importlib
    import pkgutil

    for module in pkgutil.iter_modules(__path__):
        importlib.import_module(f"{__name__}.{module.name}")


def all_queries():
    _load()
    return dict(QUERIES)


def all_sql():
    _load()
    return dict(ORACLES)
