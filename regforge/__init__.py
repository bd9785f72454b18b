"""Registry extracts to model-ready datasets, and scoring of model output, on Spark.

Every public function takes DataFrames and column names and returns a lazy
DataFrame; none of them runs an action unless its docstring says so.
"""

__version__ = "0.1.0"
