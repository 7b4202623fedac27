"""Evidence-anchored search over article corpora, as Spark DataFrames."""
