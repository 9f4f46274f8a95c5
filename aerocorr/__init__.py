"""aerocorr — correlating sensor readings with where the sensors stand.

Every public operator is a ``DataFrame -> DataFrame`` function built from
native Spark expressions.  Actions are few and bounded: the sinks
(``materialize``, CSV export), in the nearest-site search two aggregates over
the site table, a checkpoint of phase 0 and ``limit(1)`` probes, a row-count
probe of at most ``max_rows + 1`` rows before a broadcast, two scalar means in
the pooled correlation, and the counts of the samplers.
"""

from aerocorr.config import work_dir, ensure_checkpoint_dir  # noqa: F401

__version__ = "0.1.0"
