"""parlance — a Spark-native transcript feature engine.

Transcripts are parsed into line and word tables, enriched with metadata
derived from names and folders, tallied into grammatical features, scored
against word-frequency lexicons, and split / verified / corrected as a
feature table.  Every operator is a ``DataFrame -> DataFrame`` or
``Column -> Column`` function, so Catalyst plans the whole flow.
"""

__version__ = "0.1.0"
