"""batchkit: batch warehouse operators expressed as Spark DataFrame / SQL plans.

Every operator is a function that takes and returns a ``DataFrame`` or a
``Column`` so it composes with ``df.transform(...)`` and stays inside
Catalyst (pushdown, pruning, partial aggregation, whole-stage codegen).
"""

from batchkit.session import get_session, shared_dir, table

__all__ = ["get_session", "shared_dir", "table"]
