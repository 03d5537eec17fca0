"""tessera: Spark-native operators for building, cleaning, checking and
evaluating tabular price-estimation datasets.

Every operator takes and returns DataFrames; fitted state is a small
statistics DataFrame or a Spark ML model.
"""
__version__ = "0.1.0"
