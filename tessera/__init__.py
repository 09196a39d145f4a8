"""tessera: batch analytics operators written as Spark DataFrame / SQL / spark.ml code.

Every operator takes DataFrames and returns a DataFrame; column names and
thresholds are arguments.  Sub-packages:

* ``sources``   – file scans and sinks (CSV, text, shared scratch folder)
* ``functions`` – column expressions (numeric tests, tokenizers, markup parsing)
* ``operators`` – cleaning, ranking, text features, retrieval, regression,
                  logistic regression, spark.ml pipelines, clustering, metrics
* ``plans``     – bindings of the operators to the driver tables + oracle SQL
"""

from tessera.session import get_session, shared_dir, scratch_path  # noqa: F401

__all__ = ["get_session", "shared_dir", "scratch_path"]
