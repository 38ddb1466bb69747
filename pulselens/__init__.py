"""pulselens: product-analytics operators on Spark DataFrames.

Every operator takes DataFrames plus explicit parameters (never the wall
clock) and returns a lazy DataFrame; nothing is collected to the driver.
"""

from pulselens.session import get_session, shared_dir

__all__ = ["get_session", "shared_dir"]
