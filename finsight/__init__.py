"""finsight — bank & insurance analytics expressed as Spark DataFrame plans.

Layers (each a set of pure functions ``(inputs, Params) -> DataFrame``):

* ``sources``   — raw tables: CSV ingest + normalisation, fixture mapping, schedule expansion
* ``operators`` — staging projections, aggregates, windows, feature models, scores, data checks
* ``plans``     — marts, the model registry / layered runner, skew-aware physical helpers
* ``streaming`` — incremental (file-triggered) ingestion into the raw layer
"""

from finsight.params import Params

__all__ = ["Params"]
