"""Point-in-time feature engineering and slate scoring as PySpark plans.

Layers:

* ``functions``  Column -> Column expressions (coercion, text keys, scoring).
* ``operators``  DataFrame -> DataFrame building blocks (rolling, as-of, ...).
* ``sources``    readers, writers, feed and page flatteners, table contracts.
* ``plans``      composed feature views, marts, boards and the outcome model.
"""
