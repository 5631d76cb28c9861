"""Corpus analytics as Spark DataFrame jobs.

Word counts and top lists, directed word co-occurrence as pairs or stripes,
stemmed document frequency and TF-IDF. Every public function takes and returns
DataFrames (or Columns) and only describes the work; Spark runs it.
"""

__version__ = "0.1.0"
