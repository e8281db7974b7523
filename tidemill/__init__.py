"""tidemill: real-time order analytics as plain Spark DataFrame transforms.

Every transform takes and returns a DataFrame and runs unchanged on batch
(``spark.read``) and streaming (``spark.readStream``) input.
"""

from tidemill.session import prepare_session, scratch_path

__all__ = ["prepare_session", "scratch_path"]
