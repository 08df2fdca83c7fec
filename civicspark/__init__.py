"""civicspark: regional open-data analytics as Spark DataFrame operators and pipelines.

Layout

* ``functions``  column expressions and column-name rules
* ``operators``  DataFrame -> DataFrame building blocks
* ``sources``    readers and writers for landed files and tables
* ``streaming``  high-water marks and incremental file-stream refresh
* ``plans``      the named clean-ups, views and end-to-end runs
* ``checks``     the same operators over the shared test tables, each with its SQL twin

Every operator is lazy: it returns a DataFrame and starts no job unless its docstring
"""
