"""Layered configuration: per job and key the highest layer wins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobledger.schemas import COMMAND_LAYER


def overlay(layers: DataFrame) -> DataFrame:
    """(job_id, key, value) from rows (job_id, layer, seq, key, value).

    Within a layer the later ``seq``, of any type that sorts, wins, and of two rows with one ``seq``
    the larger value, so that the answer does not depend on how the rows are dealt. A null on the command line was never given and yields to
    the layer below; a null in a file is a value and wins over the layer below.
    """
    given = layers.where((F.col("layer") != COMMAND_LAYER) | F.col("value").isNotNull())
    winner = F.max_by("value", F.struct("layer", "seq", "value"))
    return given.groupBy("job_id", "key").agg(winner.alias("value"))
