"""taxaframe: taxonomic-profile and sequencing-read analytics as Spark DataFrame jobs.

Every operator is a plain function ``DataFrame -> DataFrame`` (or a column
expression) meant for ``df.transform(...)``; Catalyst plans the work.
"""

__version__ = "0.1.0"
