"""cohortcraft: cohort analytics, governed rollups and claim validation on Spark.

Layers (each a plain DataFrame -> DataFrame transform):

* ``sources``   readers, writers, digests and the driver-table adapters
* ``functions`` column-level helpers: lenient parsing, banding, taxonomy, metrics
* ``operators`` table-level operators: typed layer, cohort/scopes, rollups,
                exact medians, quality rules, statistics, claims, documents
* ``plans``     composite jobs and the registered query catalogue
* ``streaming`` incremental landing of raw files into the typed layer
"""

from cohortcraft.session import get_session, checkpoint_dir

__all__ = ["get_session", "checkpoint_dir"]
