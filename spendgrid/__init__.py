"""spendgrid: customer and category analytics on transaction tables, as
PySpark DataFrame operators.

Every operator takes DataFrames and plain arguments (keys, categories,
dates) and returns a DataFrame; nothing names a table or holds a session.
"""

from spendgrid.session import build_session, shared_checkpoint_dir

__all__ = ["build_session", "shared_checkpoint_dir"]
