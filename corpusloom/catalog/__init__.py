"""All registered queries; importing a module registers its queries."""

from importlib import import_module

MODULES = [
    "dedup_queries", "wiki_queries", "page_queries", "verse_queries", "token_queries",
    "training_queries", "source_queries", "job_queries",
]


def load():
    """``(queries, oracles)`` of every catalog module."""
    for name in MODULES:
        import_module(f"corpusloom.catalog.{name}")
    from corpusloom.catalog import registry

    return registry.QUERIES, registry.ORACLES
