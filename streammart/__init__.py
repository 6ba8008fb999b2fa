"""streammart: a layered e-commerce data warehouse as Spark DataFrame operators.

Raw click logs and database change events are refined layer by layer (raw,
detail, middle, statistics, reports).  Every step is a plain function from
DataFrames to DataFrames; where Spark allows it, the same function serves batch
and Structured Streaming.
"""
