"""Change tracking for document corpora on Spark.

Pages -> main-content markdown -> heading-aware chunks with normalized text
hashes -> diff against the previous snapshot -> change table, plus the
delivery, enrichment, rendering, discovery and quality operators around it.
Every operator is a DataFrame -> DataFrame (or Column -> Column) function.
"""

__version__ = "0.1.0"
