"""A three-zone (raw, trusted, refined) data lake on Spark DataFrames.

Layout of the package:

* ``schemas``    table contracts and the fixed names of each zone
* ``session``    runtime settings and the shared work folder
* ``functions``  column expressions
* ``sources``    delimited, JSON, Parquet and whole-object readers
* ``operators``  DataFrame -> DataFrame steps, usable with ``.transform``
* ``sinks``      catalogued Parquet, dated landing, chunked JSON landing
* ``plans``      the jobs built from the steps above
"""
