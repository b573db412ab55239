"""salesforge: a Spark-native library for sales-table ETL, data quality and analytics.

Every operator takes and returns ``pyspark.sql.DataFrame`` objects and is expressed with
the DataFrame/SQL API so Catalyst can prune, push down and fuse the work.  Nothing is
collected to the driver except report-sized (bounded) results.
"""

from salesforge.session import get_session, materialize

__all__ = ["get_session", "materialize"]
__version__ = "0.1.0"
