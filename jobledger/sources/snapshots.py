"""Snapshots of records as tables that are bucketed by id, so that comparing two moves no rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from jobledger.operators.records import COMPARED
from jobledger.plans.session import fresh_dir


def write_snapshot(
    records: DataFrame, table: str, buckets: int, key: str = "id", fields: Sequence[str] = COMPARED
) -> DataFrame:
    """Store ``key`` and ``fields`` of ``records`` as ``table`` and return it.

    Rows are dealt to the buckets once, a file each, sorted by the key. Snapshots with one number of
    buckets join bucket by bucket: ``compare_snapshots`` of them has no shuffle. Files go to the
    shared folder.
    """
    kept = records.select(key, *fields).repartition(buckets, key)
    path = fresh_dir(records.sparkSession, f"snapshot-{table}")
    kept.write.bucketBy(buckets, key).sortBy(key).option("path", path).saveAsTable(table)
    return records.sparkSession.table(table)
