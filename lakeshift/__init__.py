"""lakeshift: set-based Spark operators for moving, checking and governing lakehouse tables.

Sub-packages:

* ``functions``  Column -> Column helpers (cells, paths, partitions, access, measures)
* ``sources``    readers, catalog access and writers
* ``operators``  DataFrame -> DataFrame operators
* ``plans``      operators composed into the jobs a user runs
* ``rules``      rule tables for scanning and rewriting source text
* ``workload``   the registered queries and their SQL counterparts
"""
