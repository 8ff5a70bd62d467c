"""All registered queries, one module per operator group."""

from weftmart.queries import aggregates, changes, cleansing, discovery, evolution, extraction, joins, keys, projection, scalars, sinks, sources, warehouse
from weftmart.queries.registry import REGISTRY

__all__ = ["REGISTRY"]
