"""playmart: listening-event analytics on Spark.

Topic records in (Kafka or a landing folder), a de-duplicated star schema
out, and reports over it - all DataFrame, SQL and Structured Streaming code.
"""

__version__ = "0.1.0"
