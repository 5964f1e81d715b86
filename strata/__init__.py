"""strata: layered (raw -> bronze -> silver -> gold) table operators on Spark.

Every operator is a function from DataFrames to a DataFrame built only from
built-in Spark SQL expressions, so Catalyst plans it and no row is ever
shipped to a Python worker. Storage-touching helpers live in ``sources`` and
``streaming``; composite flows in ``plans``.
"""

from strata.session import get_session, scratch_path, scratch_run, sizing_conf

__all__ = ["get_session", "scratch_path", "scratch_run", "sizing_conf"]
