"""voltframe: Spark-native analytics over annual power-plant survey releases.

Layout:
  registry        S8 table catalogue and code lists
  fixtures        survey-shaped tables derived from the driver's generated data
  functions/      column-level helpers (names, predicates, casts)
  operators/      DataFrame -> DataFrame building blocks (latest, change, share, ...)
  sources/        release selection, delimited extracts, ingest transforms, sinks
  plans/          the ten analytical views, README-intent views, profiling
  jobs            schema derivation and raw load over a landing folder
"""

__version__ = "0.1.0"
