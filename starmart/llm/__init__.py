"""Operators a training-data pipeline needs, as Spark jobs over whole text tables.

Nothing else in the library imports this package. Operators move documents through
``mapInArrow`` partitions (NumPy on Arrow buffers), shuffle small aggregated rows, and
broadcast only tables whose size has a stated bound.
"""
