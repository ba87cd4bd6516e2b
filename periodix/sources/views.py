"""SQL access: the source tables and every job's output as temporary views.

Users who query the marts with SQL keep doing so with ``spark.sql``; the views are lazy, so a query
over a mart runs the job as part of its own plan (Catalyst prunes and pushes filters through it).
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from periodix.sources.raw import SOURCE_ATTRS

SOURCE_VIEWS = SOURCE_ATTRS


def register_views(world, marts: dict[str, DataFrame] | None = None) -> list[str]:
    """Register the binding's source frames (by their source-table names) and ``marts`` as temp views.

    ``world`` is any object with the source frames as attributes (a :class:`periodix.plans.build.Sources` or a
    :class:`periodix.sources.bindings.World`). Returns the registered names.
    """
    names = []
    for view, attr in SOURCE_VIEWS.items():
        getattr(world, attr).createOrReplaceTempView(view)
        names.append(view)
    for view, df in (marts or {}).items():
        df.createOrReplaceTempView(view)
        names.append(view)
    return names
