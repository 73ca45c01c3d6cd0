"""ratewise: recommendation analytics expressed as Spark DataFrame jobs.

Every operator takes DataFrames and returns a DataFrame; nothing on a data
path is collected to the driver.  ``ratewise.plans`` wires the operators
into the named queries exposed through ``__spark_entry__.py``.
"""

from ratewise.session import build_session, checkpoint_dir

__all__ = ["build_session", "checkpoint_dir"]
