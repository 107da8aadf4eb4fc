"""ledgerline: subscription and billing analytics as Spark DataFrame operators.

Layout
------
- ``sources``    reading the input tables, the derived fixture views, writing models
- ``functions``  Column -> Column helpers (surrogate keys, JSON fields, tags, dates)
- ``operators``  DataFrame -> DataFrame building blocks (latest row per key, interval
                 merge, period grids, coverage, null-aware anti join, duplicates, ...)
- ``plans``      the ready models built from the operators (paid periods, paid
                 years/months/quarters, client status, subscription/ticket match,
                 duplicate invoices, client reports)
"""

from ledgerline.session import build_session, checkpoint_dir

__all__ = ["build_session", "checkpoint_dir"]
