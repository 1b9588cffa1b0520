"""Submissions: job rows with local and cluster files to request rows ready to be sent."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobledger.functions.artifacts import python_conf, resolve_artifact
from jobledger.functions.text import merge_conf, request_json
from jobledger.schemas import CONF_PREFIX, REQUEST_FIELDS

_LISTS = ("archives", "args", "pyFiles")
_NUMBERS = ("driverCores", "executorCores", "numExecutors")


def submissions(settings: DataFrame, jobs: DataFrame | None = None, job: str = "job_id") -> DataFrame:
    """Rows (job_id, key, value) of ``overlay`` as the typed columns that ``submission_requests`` takes.

    Entries of ``conf`` become a map, lists are read from their JSON text, and a number that is none
    is null. Keys that no request has are left out, but for ``conda_env``. ``jobs`` adds its columns
    by ``job``, one row each, and keeps jobs without settings.
    """
    wanted = [*REQUEST_FIELDS, "conda_env"]
    read = F.col("key").isin(wanted) | F.col("key").startswith(CONF_PREFIX)
    # One map a job, read by key below; an aggregate for each field would compare texts a dozen times.
    entries = F.collect_list(F.when(read, F.struct("key", "value")))
    found = settings.groupBy("job_id").agg(F.map_from_entries(entries).alias("_given"))

    def typed(field: str) -> Column:
        if field == "conf":
            conf = F.map_filter("_given", lambda key, _: key.startswith(CONF_PREFIX))
            name = lambda key, _: F.substring(key, len(CONF_PREFIX) + 1, 2**31 - 1)
            return F.transform_keys(conf, name)
        value = F.try_element_at("_given", F.lit(field))
        if field in _LISTS:
            return F.from_json(value, "array<string>")
        return value.try_cast("int") if field in _NUMBERS else value

    found = found.select("job_id", *[typed(field).alias(field) for field in wanted])
    if jobs is None:
        return found
    return jobs.join(found.withColumnRenamed("job_id", job), job, "left")


def submission_requests(jobs: DataFrame, run_dir: Column) -> DataFrame:
    """Add ``rejected`` and ``request`` to job rows.

    ``jobs`` has the request fields and ``conda_env``, a packed environment or null. All files
    resolve against ``run_dir``. ``rejected`` lists the URIs that no rule accepts; where there is
    one, ``request`` is null. Otherwise it is the JSON of the fields that are not null.
    """

    def resolved(kind: str, uris: Column) -> Column:
        return F.transform(uris, lambda uri: resolve_artifact(F.lit(kind), uri, run_dir))

    none = F.array().cast("array<string>")
    env = F.when(F.col("conda_env").isNotNull(), F.array("conda_env")).otherwise(none)
    resolved_jobs = jobs.withColumns(
        {"_env": resolved("env", env), "_archives": resolved("archive", F.coalesce("archives", none))}
    )
    # An environment on the cluster leads; an uploaded one goes last, behind the other archives.
    leading = F.filter("_env", lambda file: file["action"] == "pass")
    trailing = F.filter("_env", lambda file: file["action"] != "pass")
    ordered = resolved_jobs.withColumn("_files", F.concat(leading, "_archives", trailing))
    rejected = F.transform(
        F.filter("_files", lambda file: file["action"] == "reject"), lambda file: file["base"]
    )

    ready = {
        "file": resolve_artifact(F.lit("file"), F.col("file"), run_dir)["output"],
        "archives": F.transform("_files", lambda file: file["output"]),
        "pyFiles": F.transform(resolved("pyFile", F.col("pyFiles")), lambda file: file["output"]),
        "conf": merge_conf(
            "conf",
            F.create_map(F.lit("spark.logConf"), F.lit("true")),
            python_conf("conda_env"),
            log_conf=False,
        ),
    }
    fields = [ready.get(name, F.col(name)).alias(name) for name in REQUEST_FIELDS]
    return (
        ordered.withColumn("rejected", rejected)
        .withColumn("request", F.when(F.size("rejected") == 0, request_json(*fields)))
        .drop("_env", "_archives", "_files")
    )
