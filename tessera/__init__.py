"""tessera: Spark-native analysis operators over DataFrames.

Every public function takes and returns DataFrames; the heavy work runs on
executors through built-in Spark SQL expressions and ``pyspark.ml``.
"""

__version__ = "0.1.0"
