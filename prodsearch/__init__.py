"""prodsearch: a PySpark toolkit for a financial-product catalogue.

Stages, all as DataFrame -> DataFrame functions:
``sources`` (landed pages, CSV, Parquet), ``operators`` (cleaning, joins,
statistics, dialogue windows, retrieval), ``functions`` (column
expressions), ``plans`` (collect / preprocess / recommend jobs) and
``streaming`` (incremental landing of pages).
"""

__version__ = "0.1.0"
