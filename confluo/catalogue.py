"""All registered queries of the record-linkage toolkit, with their SQL."""

from confluo.plans import columns, enrich, feeds, health, publish, resolution, rules  # noqa: F401  each registers its queries
from confluo.plans.registry import ORACLE_SQL, QUERIES  # noqa: F401
