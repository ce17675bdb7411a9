"""yearwheel: rolling-year cubes and star-schema extracts on Spark.

Layers, from the inside out:

``functions``   column expressions (period labels, bands, recodes, text)
``operators``   DataFrame -> DataFrame steps (rolling years, cubes, lookups, checks)
``sources``     typed readers for fact tables, lookups, concordances and bundles
``sinks``       the star-schema bundle writer
``plans``       extract specifications and the four extracts built from them
"""

__version__ = "0.1.0"
