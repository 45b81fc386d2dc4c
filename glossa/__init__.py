"""glossa — review and social-media analytics as composable Spark DataFrame operators.

Every operator is a function ``op(df, *, params) -> DataFrame`` that only
extends the lazy logical plan; Catalyst/AQE choose the physical strategy.
"""

__version__ = "0.1.0"
