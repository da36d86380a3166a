"""clickloom: ad-log and identity analytics as Spark DataFrame operators.

Every public operator takes DataFrames and parameters and returns a DataFrame.
Spark plans, partitions and runs the work; nothing here holds table data on
the driver.
"""
