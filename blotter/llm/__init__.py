"""Training-data operators.

One module per operator, each with a general ``DataFrame -> DataFrame`` interface, and
``queries`` with the registered queries and their SQL twins. Nothing outside this package
imports it, except the guarded registration in ``__spark_entry__.py`` and the pipeline.
"""
