"""Schemas of the data the operators read."""

from __future__ import annotations

from pyspark.sql import types as T

# The states of a job that is not over yet. Every other state is terminal.
ACTIVE_STATES = ("running", "starting")

# Fixed value: the header inside a job's log array where stderr begins.
STDERR_MARKER = "\nstderr: "

JOB_RECORD = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("name", T.StringType()),
        T.StructField("appId", T.StringType()),
        T.StructField(
            "appInfo",
            T.StructType(
                [
                    T.StructField("driverLogUrl", T.StringType()),
                    T.StructField("sparkUiUrl", T.StringType()),
                ]
            ),
        ),
        T.StructField("log", T.ArrayType(T.StringType())),
        T.StructField("state", T.StringType()),
    ]
)

# One reply of the listing call: the records of one page and where the page starts.
LISTING = T.StructType(
    [
        T.StructField("from", T.LongType()),
        T.StructField("total", T.LongType()),
        T.StructField("sessions", T.ArrayType(JOB_RECORD)),
    ]
)

# The fields of a submission, in the order of the request.
REQUEST_FIELDS = (
    "file",
    "name",
    "driverMemory",
    "driverCores",
    "executorMemory",
    "executorCores",
    "numExecutors",
    "archives",
    "queue",
    "conf",
    "args",
    "pyFiles",
)

# One notebook configuration file; only these two parts of it matter.
NOTEBOOK_CONFIG = T.StructType(
    [
        T.StructField(
            "kernel_python_credentials", T.StructType([T.StructField("url", T.StringType())])
        ),
        T.StructField("session_configs", T.MapType(T.StringType(), T.StringType())),
    ]
)

# Configuration layers, lowest precedence first.
NOTEBOOK_LAYER, TOOL_LAYER, COMMAND_LAYER = 0, 1, 2
# What stands before the name of an entry of ``conf`` where it is a key of its own.
CONF_PREFIX = "conf."
