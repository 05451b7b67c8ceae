"""listenlake: listening-event analytics on a medallion layout, as Spark jobs.

Every operator is a ``DataFrame -> DataFrame`` function built from Spark's own
expressions.  Reading and writing live in ``sources``, ``sinks`` and
``streaming``; ``plans`` wires the pieces into whole jobs.
"""

__version__ = "0.1.0"
