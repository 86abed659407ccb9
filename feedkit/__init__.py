"""feedkit: warehouse feed work (extract, repair, load, report) as plain PySpark.

Every operator is a function over DataFrames or Columns.  Nothing here runs a
job by itself unless its docstring says so, so plans stay lazy and Catalyst
sees the whole of them.
"""
