"""Writing output tables so that a re-run replaces a deal instead of doubling it."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame

from stocklens.sources.published import write_run


def write_output(df: DataFrame, root: str, name: str, deals: Iterable[int] | None = None) -> str:
    """Replace deals within the table ``<root>/<name>``, as a publication of that one table; other deals stay.

    ``deals`` are those of the run: one without rows in ``df`` is emptied too. Without it only deals
    that have rows are replaced.
    """
    write_run({name: df}, root, deals)
    return f"{root.rstrip('/')}/{name}"
