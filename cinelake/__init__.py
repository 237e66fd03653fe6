"""cinelake: a Spark-native medallion engine for a movie catalogue.

Raw API responses land as JSON text; ``sources`` turns them into append-only
bronze tables with a VARIANT column, ``plans.silver`` parses, flattens and
deduplicates them, ``plans.gold`` builds the star schema, ``operators.quality``
runs the declared data tests as DataFrames and ``plans.discover`` answers the
catalogue questions.  Everything is DataFrame / Spark SQL; no UDFs.
"""

__all__ = ["session"]
