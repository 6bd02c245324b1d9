"""Move relational tables from one shape to another on Spark.

scan -> clean -> resolve keys -> merge -> reconcile, for batch loads and for
increments, always as DataFrame plans that Catalyst optimises.
"""

__version__ = "0.1.0"
