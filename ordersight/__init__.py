"""ordersight: order-quality, late-delivery scoring and model-health analytics on Spark.

Every operator is a function from DataFrame(s) to a DataFrame, so it runs the
same in a batch job, inside ``foreachBatch`` of a Structured Streaming query,
or on a 1000-executor cluster.
"""

__all__ = ["session", "options", "schemas"]
