"""Asset-management warehouse as Spark jobs.

Layers: ``STG_*`` (raw batches) -> ``VOR_*`` (validated, normalised) ->
``DIM_*`` / ``FAKT_*`` (star schema).  Operators are ``DataFrame -> DataFrame``
functions; only :mod:`depotwerk.sources.store` and :mod:`depotwerk.plans.control`
touch storage.
"""
