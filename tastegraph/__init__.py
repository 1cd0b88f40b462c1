"""tastegraph — collaborative-filtering recommenders as Spark DataFrame plans.

Every operator is a function ``DataFrame -> DataFrame`` built from Spark SQL
expressions, joins, aggregations and windows (plus ``pyspark.ml`` ALS), so the
work is planned by Catalyst and runs on the executors.  Nothing data-sized is
collected to the driver.
"""

from tastegraph.session import build_session, shared_dir

__all__ = ["build_session", "shared_dir"]
