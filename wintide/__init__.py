"""wintide: customer-lifecycle analytics as Spark DataFrame plans.

``functions``  Column -> Column helpers (ids, bands, elapsed time, NULL-strict maths)
``operators``  DataFrame -> DataFrame building blocks (as-of joins, latest rows, roll-ups, cohorts)
``plans``      the composed reports built from those operators
``sources``    table reading and writing, input schemas, staging
"""
