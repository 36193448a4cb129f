"""ratecell: portfolio exhibits on Spark.

Every public function takes DataFrames (or Columns) and returns DataFrames (or
Columns); the work is planned by Catalyst and runs on the executors. Nothing is
collected to the driver except in the explicit checks in ``operators.checks``,
which reduce to a single row first.

Layout
------
``functions``  Column -> Column helpers (null defaults, bands, company map, FSA).
``operators``  DataFrame -> DataFrame building blocks (schema, filters, joins,
               aggregates, window/dedup, checks).
``plans``      the exhibits as one call each (classification, ELR, earning,
               dislocation, scoring).
``sources``    catalog resolution, extracts, sinks and the fixture book built
               from the driver's test tables.
``streaming``  nothing yet; see its docstring.
"""

__all__ = ["functions", "operators", "plans", "sources"]
