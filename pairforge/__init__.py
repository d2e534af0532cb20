"""pairforge: text pairs -> validated chat-format training data, on Spark.

Entry points:

* ``pairforge.operators.pairs``: pair sources (Parquet files, JSON-array files,
  any DataFrame), cleaning, length filter, caps and the ordered union;
* ``pairforge.plans.build``: the build (records, exact seeded split, JSON lines);
* ``pairforge.plans.check``, ``pairforge.plans.subsample``: validation and
  seeded subsampling of written split files;
* ``pairforge.operators.rewrite``: batch rewriting and before/after comparison;
* ``python -m pairforge``: the same as a command line.

All functions take and return DataFrames; none creates a session.
"""

__version__ = "0.1.0"
