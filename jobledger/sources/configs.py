"""Configuration of submissions: scans of notebook and tool files, and their rows as layers."""

from __future__ import annotations

import logging
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from jobledger.functions.logs import _col
from jobledger.functions.text import parse_kv, split_host_port
from jobledger.schemas import COMMAND_LAYER, CONF_PREFIX, NOTEBOOK_CONFIG, NOTEBOOK_LAYER, TOOL_LAYER

log = logging.getLogger(__name__)

_TEXT_MAP = T.MapType(T.StringType(), T.StringType())


def _documents(spark: SparkSession, paths: str | Sequence[str], multi_line: bool) -> DataFrame:
    """(path, place, document): one row per file, or per line that is not blank. Missing paths add none.

    ``place`` is a number in the order of the paths and, within one, of its lines.
    """
    roots = [paths] if isinstance(paths, str) else list(paths)
    found = [root for root in roots if _exists(spark, root)]
    for root in roots:
        if root not in found:
            log.warning("%s not found, no configuration from there", root)
    if not found:
        return spark.createDataFrame([], "path string, place decimal(38,0), document string")
    files = spark.read.text(found, wholetext=multi_line)
    listed = enumerate(sorted(set(files.inputFiles())))  # the reader has listed them all here anyway
    ranks = spark.createDataFrame([(path, rank) for rank, path in listed] or [], "path string, rank bigint")
    # A task reads the lines of a block in their order, and an id counts them in its lower 33 bits.
    line = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    rows = files.select(
        F.col("_metadata.file_path").alias("path"),
        (F.col("_metadata.file_block_start").cast("decimal(14,0)") * F.lit(10**10).cast("decimal(11,0)") + line).alias("at"),
        F.col("value").alias("document"),
    )
    place = F.col("rank").cast("decimal(12,0)") * F.lit("1" + "0" * 24).cast("decimal(25,0)") + F.col("at")
    rows = rows.join(ranks, "path", "left").select("path", place.cast("decimal(38,0)").alias("place"), "document")
    return rows if multi_line else rows.where(F.trim("document") != "")


def _exists(spark: SparkSession, path: str) -> bool:
    """Whether there is anything at a path, which may have wildcards; a listing, no job."""
    try:
        spark.read.format("binaryFile").load(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return False
    return True


def _raised(status: Column, strict: bool) -> Column:
    """The status, or with ``strict`` an error for one that the command would fail on."""
    if not strict:
        return status
    failed = F.raise_error(F.concat(F.lit("configuration is "), status))
    return F.when(status.isin("malformed", "no_port"), failed.cast("string")).otherwise(status)


def config_scan(
    spark: SparkSession, paths: str | Sequence[str], multi_line: bool = True, strict: bool = False
) -> DataFrame:
    """(path, place, url, port, address, session_configs, status), one row per notebook configuration.

    ``multi_line`` reads one configuration per file, otherwise one per line. Columns and ``strict``
    are those of ``config_rows``. A path that does not exist adds no row and is logged.
    """
    return config_rows(_documents(spark, paths, multi_line), "document", "path", "place", strict=strict)


def config_rows(rows: DataFrame, document: Column | str, *keep: str, strict: bool = False) -> DataFrame:
    """(keep.., url, port, address, session_configs, status) from a column that holds the JSON text.

    ``address`` is the text of the credentials' url. ``status`` is ``ok``; ``no_credentials`` or
    ``no_port``, with url and port null; or ``malformed`` for text that is no JSON object, with all
    of them null and an empty map. ``strict`` raises for the last two. Without session configs the map
    is empty.
    """
    schema = T.StructType([*NOTEBOOK_CONFIG.fields, T.StructField("_bad", T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"}
    document = _col(document)
    rows = rows.withColumn("_config", F.from_json(document, schema, options))
    address = F.col("_config.kernel_python_credentials.url")
    cut = split_host_port(address)
    malformed = F.col("_config").isNull() | F.col("_config._bad").isNotNull()
    status = (
        F.when(malformed, F.lit("malformed"))
        .when(address.isNull(), F.lit("no_credentials"))
        .otherwise(cut["status"])
    )
    known = F.when(~malformed, F.col("_config.session_configs"))
    return rows.select(
        *keep,
        F.when(~malformed, cut["host"]).alias("url"),
        F.when(~malformed, cut["port"]).alias("port"),
        F.when(~malformed, address).alias("address"),
        F.coalesce(known, F.create_map().cast("map<string,string>")).alias("session_configs"),
        _raised(status, strict).alias("status"),
    )


def tool_scan(
    spark: SparkSession, paths: str | Sequence[str], multi_line: bool = True, strict: bool = False
) -> DataFrame:
    """(path, place, settings, status), one row per configuration of the submitting tool."""
    return tool_rows(_documents(spark, paths, multi_line), "document", "path", "place", strict=strict)


def tool_rows(rows: DataFrame, document: Column | str, *keep: str, strict: bool = False) -> DataFrame:
    """(keep.., settings, status): the keys of a JSON object, nested values as their JSON text.

    ``status`` is ``ok`` or, with no settings, ``malformed``.
    """
    parsed = F.from_json(_col(document), _TEXT_MAP, {"mode": "PERMISSIVE"})
    rows = rows.withColumn("_settings", parsed)
    status = F.when(F.col("_settings").isNull(), F.lit("malformed")).otherwise(F.lit("ok"))
    settings = F.coalesce("_settings", F.create_map().cast("map<string,string>"))
    return rows.select(*keep, settings.alias("settings"), _raised(status, strict).alias("status"))


def _unfolded(settings: Column) -> Column:
    """The settings with the entries of ``conf`` as keys of their own."""
    nested = F.from_json(F.element_at(settings, F.lit("conf")), _TEXT_MAP)
    empty = F.create_map().cast("map<string,string>")
    entries = F.transform_keys(
        F.coalesce(nested, empty), lambda key, _: F.concat(F.lit(CONF_PREFIX), key)
    )
    plain = F.map_filter(settings, lambda key, _: (key != "conf") & ~key.startswith(CONF_PREFIX))
    return F.map_concat(plain, entries)


def _layer(rows: DataFrame, job: str, number: int, settings: Column) -> DataFrame:
    # Several files of a job: the later path and, within it, the later line wins.
    place = F.col("place") if "place" in rows.columns else F.lit(0)
    layer = rows.select(
        F.col(job).alias("job_id"),
        F.lit(number).alias("layer"),
        place.alias("seq"),
        # The outer explode builds the map once, without a look at its size first.
        F.explode_outer(settings).alias("key", "value"),
    )
    return layer.where(F.col("key").isNotNull())


def config_layer(settings: DataFrame, job: str) -> DataFrame:
    """Settings as rows (job_id, layer, seq, key, value) of the lowest configuration layer.

    ``seq`` is the ``place`` of ``config_scan``, or 0 for rows without one.
    Every entry of ``conf`` is a key of its own, ``conf.`` and its name, so layers merge it entry by
    entry.
    """
    own = F.create_map(
        F.lit("server_url"), F.col("url"), F.lit("server_port"), F.col("port")
    )
    kept = F.map_filter("session_configs", lambda key, _: ~key.isin("server_url", "server_port"))
    return _layer(settings, job, NOTEBOOK_LAYER, F.map_concat(_unfolded(kept), own))


def tool_layer(settings: DataFrame, job: str) -> DataFrame:
    """The same rows of the middle layer, from ``tool_rows``."""
    return _layer(settings, job, TOOL_LAYER, _unfolded(F.col("settings")))


def command_layer(
    commands: DataFrame, job: str, fields: Sequence[str], conf: str | None = None
) -> DataFrame:
    """The same rows of the top layer, from text columns named as the settings they set.

    ``conf`` names an array of ``key=value`` items; an item without ``=`` fails.
    """
    given = F.create_map(*[x for name in fields for x in (F.lit(name), F.col(name).cast("string"))])
    if conf is not None:
        items = F.coalesce(F.col(conf), F.array().cast("array<string>"))
        entries = F.transform_keys(
            parse_kv(items, strict=True)["conf"], lambda key, _: F.concat(F.lit(CONF_PREFIX), key)
        )
        given = F.map_concat(given, entries)
    return _layer(commands, job, COMMAND_LAYER, given)
