"""Recommendation analytics as composable Spark DataFrame operators.

Two recommenders re-expressed Spark-first:

* rating prediction: density statistics, Pearson user-user neighbours, damped
  baseline predictors and residual item-item cosine with top-k prediction
  (``affinity.operators.stats``, ``user_cf``, ``baseline``, ``item_cf``, ``report``);
* click-graph candidates ranked by the text of the items
  (``affinity.operators.graph``, ``content``).

Every operator takes and returns DataFrames. No operator collects data to the
driver, loops per target, or calls a Python UDF.
"""

__version__ = "0.1.0"
