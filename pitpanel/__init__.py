"""pitpanel — point-in-time-correct panel analytics on Spark.

Every operator is a ``DataFrame -> DataFrame`` function built from native
Spark SQL expressions, parameterised by column names.  Strictly-prior
windows go through :func:`pitpanel.functions.windows.prior` so that the
leakage contract is enforced in one place.
"""

__version__ = "0.1.0"
