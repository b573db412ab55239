"""Query registrations, one module per area; importing the package registers them all."""

from salesforge.plans.catalog import sales  # noqa: F401
from salesforge.plans.catalog import analytics, charts, etl, quality, variants  # noqa: F401
from salesforge.plans.catalog import reports  # noqa: F401, I001  (after the twins it counts)
