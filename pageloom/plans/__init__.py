"""Named queries, grouped by area; importing the package registers all of them."""

from pageloom.plans import registry
from pageloom.plans.registry import NamedQuery

_AREAS = (
    "url_queries",
    "response_queries",
    "link_queries",
    "merge_queries",
    "crawl_queries",
    "extract_queries",
    "stream_queries",
    "analysis_queries",
    "relational_queries",
)


def all_queries() -> dict[str, NamedQuery]:
    from importlib import import_module

    for area in _AREAS:
        import_module(f"pageloom.plans.{area}")
    return registry.all_queries()
