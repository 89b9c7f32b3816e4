"""foldline: Spark-native tabular feature engineering and stacked regression.

Every operator is either a function ``DataFrame -> DataFrame`` or a
``fit(df) -> model``/``model.transform(df)`` pair built on Spark SQL
expressions, aggregates, joins and MLlib.
"""

__version__ = "0.1.0"
