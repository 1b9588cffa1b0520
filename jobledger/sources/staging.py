"""Write a table into a fresh run directory."""

from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame


def run_directory(user: str, root: str = "/user", folder: str = "staged-files") -> str:
    """``{root}/{user}/{folder}/{six hex digits}_{seconds}``, new for every call.

    The form of the path is a fixed value.
    """
    return f"{root.rstrip('/')}/{user}/{folder}/{uuid.uuid4().hex[:6]}_{round(time.time())}"


def staged_write(rows: DataFrame, user: str, directory: str | None = None, root: str = "/user") -> str:
    """Write ``rows`` as Parquet into ``directory`` (or a new run directory) and return the path.

    A directory that exists is overwritten.
    """
    path = directory or run_directory(user, root)
    rows.write.mode("overwrite").parquet(path)
    return path
