"""Monthly incident analytics on Spark.

Layers, each a plain ``DataFrame -> DataFrame`` function:

* ``sources``   landing JSON scan and write, raw-table load, month replace
* ``operators`` staging casts, JSON flatten, marts, serving summaries, geo, data quality
* ``functions`` column expressions shared by the operators (months, labels, numbers)
* ``plans``     the whole monthly build and the query catalogue
* ``streaming`` the same month replace driven by newly arrived landing files
"""

from blotter.session import configure, scratch_path

__all__ = ["configure", "scratch_path"]
