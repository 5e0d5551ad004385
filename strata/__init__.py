"""strata — layered (bronze → silver → gold) dimension and fact pipelines on Spark.

Every operator is a pure ``DataFrame -> DataFrame`` function (or a Column
expression) that Spark plans and executes; the package never loops over data on
the driver.  Sub-packages:

* ``strata.sources``   scans, sinks, settings, the test-table fixture views
* ``strata.functions`` Column expressions (text, keys, dates, predicates)
* ``strata.operators`` composite operators (contracts, quality gates, hierarchy
  flattening, SCD versioning, calendar, star lookup, upsert, refresh, audit)
* ``strata.plans``     end-to-end pipelines and the registered queries
* ``strata.streaming`` incremental file arrival
"""

__version__ = "0.1.0"
