"""shelfscope: retail analytics as lazy Spark DataFrame operators.

Every public operator takes DataFrames (plus column names / parameters) and
returns a DataFrame without triggering an action, so a whole analysis stays
one Catalyst plan until the caller writes or collects it.
"""

__version__ = "0.1.0"
