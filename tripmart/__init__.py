"""tripmart: monthly trip-record analytics as plain Spark DataFrame plans.

Layers (all lazy DataFrames, built-in Spark functions only, no UDFs):

* ``sources``   - raw/bronze readers, zone lookup CSV, file manifest, period spine.
* ``functions`` - reusable Column expressions (calendar keys, windows, key maps, formats).
* ``operators`` - conform, validate, dedupe, dimensions, fact, contracts, profile, loads.
* ``plans``     - business marts, dashboard-style reports, the period pipeline and the
                  query catalogue used by ``__spark_entry__``.
* ``streaming`` - incremental (file-arrival) processing of monthly raw drops.
"""

from tripmart.session import configure, scratch_dir

__all__ = ["configure", "scratch_dir"]
