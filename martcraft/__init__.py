"""martcraft: commerce & advertising analytics marts as Spark DataFrame jobs.

Layers: ``sources`` shape landed records into typed tables, ``functions``
hold reusable Column expressions, ``operators`` hold multi-step DataFrame
patterns (unions, anti-fill, bounded top-k), ``plans`` build the views and
marts, ``sinks`` implement the idempotent write modes and ``streaming``
the intraday micro-batch path.  Every plan is a pure function
``(DataFrames, as_of, ...) -> DataFrame``; I/O lives in sources and sinks.
"""

__version__ = "0.1.0"
