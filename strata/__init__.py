"""strata: clickstream medallion analytics (bronze -> silver -> gold) as Spark DataFrame jobs.

Every operator is a pure ``DataFrame -> DataFrame`` function built from Spark SQL built-ins,
so Catalyst plans, prunes and pushes down everything; no Python runs inside tasks.
"""

__version__ = "0.1.0"
