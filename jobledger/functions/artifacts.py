"""Where the files of a submission end up: pass through, upload below the run folder, or reject."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from jobledger.functions.logs import _col, bind

# The schemes that the cluster reads by itself.
CLUSTER_SCHEMES = ("hdfs", "s3")
# Fixed value: what counts as a scheme at the start of a URI.
SCHEME = r"^([A-Za-z][A-Za-z0-9+.-]*):"
# Fixed value: the keys under which the interpreter of a packed environment is set.
PYTHON_KEYS = ("spark.pyspark.python", "spark.yarn.appMasterEnv.PYSPARK_PYTHON")


def scheme(uri: Column | str) -> Column:
    """The lower-case scheme, or an empty string."""
    return F.lower(F.regexp_extract(_col(uri), SCHEME, 1))


def env_python(uri: Column | str) -> Column:
    """``./{root}/bin/python``, with the text after the first ``#`` or else the file name as root."""
    uri = _col(uri)
    cut = F.instr(uri, "#")
    fragment = F.when(cut > 0, F.substring(uri, cut + 1, F.length(uri))).otherwise(F.lit(""))
    path = F.substring_index(F.substring_index(uri, "#", 1), "?", 1)
    path = F.regexp_replace(path, SCHEME, "")
    path = F.regexp_replace(path, r"^//[^/]*", "")
    name = F.substring_index(path, "/", -1)
    # Without a cluster scheme a file name ends where its ;parameters start.
    name = F.when(scheme(uri).isin(*CLUSTER_SCHEMES), name).otherwise(F.substring_index(name, ";", 1))
    root = F.when(fragment != "", fragment).otherwise(name)
    return F.concat(F.lit("./"), root, F.lit("/bin/python"))


def python_conf(uri: Column | str) -> Column:
    """The conf entries of a packed environment; null for a null URI."""
    path = env_python(uri)
    pairs = [part for key in PYTHON_KEYS for part in (F.lit(key), path)]
    return F.when(_col(uri).isNotNull(), F.create_map(*pairs))


def resolve_artifact(
    kind: Column | str, uri: Column | str, run_dir: Column | str, strict: bool = False
) -> Column:
    """Struct (scheme, base, symlink, action, output) for one artifact.

    ``kind`` is a column with ``file``, ``env``, ``archive`` or ``pyFile``; ``run_dir`` the folder
    of the main file. ``action`` is ``pass``, ``upload`` or ``reject`` (``strict`` raises instead);
    nothing is moved. Archives on the cluster pass through unchanged; only a local archive with
    exactly one ``#`` is cut into base and symlink.
    """
    kind, uri, run_dir = _col(kind), _col(uri), _col(run_dir)
    packed = kind.isin("env", "archive")
    found = scheme(uri)
    parts = F.split(uri, "#")
    linked = packed & (F.size(parts) == 2) & (found == "")
    action = (
        F.when(packed & found.isin(*CLUSTER_SCHEMES), F.lit("pass"))
        .when(packed & (found != ""), F.lit("reject"))
        .otherwise(F.lit("upload"))
    )

    def uploaded(path: Column) -> Column:
        return F.concat(run_dir, F.lit("/"), F.substring_index(path, "/", -1))

    rejected = F.lit(None).cast("string")
    if strict:
        rejected = F.raise_error(F.concat(F.lit("no hdfs, s3 or local path: "), uri)).cast("string")
    local = F.when(
        packed & (F.size(parts) == 2),
        F.concat(
            uploaded(parts[0]), F.when(parts[1] != "", F.concat(F.lit("#"), parts[1])).otherwise("")
        ),
    ).otherwise(uploaded(uri))
    output = F.when(kind == "file", uploaded(uri)).otherwise(
        bind(
            action,
            lambda action: F.when(action == "pass", uri)
            .when(action == "reject", rejected)
            .otherwise(F.concat(F.lit("hdfs://"), local)),
        )
    )
    return F.struct(
        found.alias("scheme"),
        F.when(linked, parts[0]).otherwise(uri).alias("base"),
        F.when(linked, F.nullif(parts[1], F.lit(""))).alias("symlink"),
        action.alias("action"),
        output.alias("output"),
    )
