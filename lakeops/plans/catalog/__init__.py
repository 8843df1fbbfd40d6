"""All registered queries; importing this package fills the registry."""

from lakeops.plans.catalog import (  # noqa: F401
    dimension,
    medallion,
    orderlines,
    projections,
    quality,
    relations,
    retail,
    sources,
)
