"""tidewater: web-log, short-text and numeric-feed analytics on PySpark.

Every operator is a function from DataFrame to DataFrame written with
built-in Spark SQL expressions, so the same code runs on a bounded table
and on a Structured Streaming input.
"""

from tidewater.session import get_session, shared_dir

__all__ = ["get_session", "shared_dir"]
