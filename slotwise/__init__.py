"""slotwise: account-history analytics on PySpark.

Every operator takes DataFrames and returns DataFrames; nothing here starts a session by itself.
"""

__version__ = "0.1.0"
