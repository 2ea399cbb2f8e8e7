"""wattfold: medallion, star-schema and report building on Spark DataFrames.

Every function takes and returns DataFrames or Columns and stays lazy; only the
``run_*`` functions in :mod:`wattfold.plans.pipeline` and the writers in
:mod:`wattfold.sources.tables` start jobs.
"""
