"""Whole jobs built from the operators.

* ``programs``  — the reference's programs over files in their own formats
* ``*_jobs``    — queries over the driver tables, each with its DuckDB twin
                  where a closed form exists
* ``catalog``   — the registry used by ``__spark_entry__``
"""
