"""Market-abuse analytics on order flow, written as Spark DataFrame functions."""
