"""shopsignal: repeat-buyer analytics on Spark.

Profiles user/merchant tables, folds time-ordered user histories into
behaviour features, builds TF-IDF and mean-embedding features, and trains
out-of-fold stacked / bagged classifiers -- all as DataFrame, SQL and
Spark ML jobs.
"""

__version__ = "0.1.0"
