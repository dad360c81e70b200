"""emporium: commerce marts and data-quality jobs as Spark DataFrame plans.

Layers (each a function ``DataFrame -> DataFrame``):

* ``emporium.sources``   raw table schemas, CSV/Parquet readers, stand-in tables
* ``emporium.operators`` staging, intermediate and mart models; checks,
                          reconciliation and profiling operators
* ``emporium.functions`` reusable Column expressions
* ``emporium.plans``     the model graph, the 53-check suite, registered queries
"""

from emporium.session import build_session, checkpoint_dir

__all__ = ["build_session", "checkpoint_dir"]
