import json
import os
import random
from urllib.parse import urlparse

import pytest
from pyspark.sql import functions as F

from jobledger.functions import artifacts, text
from jobledger.operators.overlay import overlay
from jobledger.operators.requests import submission_requests
from jobledger.operators.requests import submissions
from jobledger.sources.configs import (
    command_layer,
    config_layer,
    config_rows,
    config_scan,
    tool_layer,
    tool_rows,
)

RUN = "/user/svc/run"


@pytest.fixture
def apply(rows):
    """``apply(values, function)``: the function over a column of strings."""
    return lambda values, function: [
        r[0] for r in rows([(v,) for v in values], "s string").select(function(F.col("s"))).collect()
    ]


def test_principal_user(apply):
    given = ["svc_user/my.hostname.com@MY.DOMAIN.COM", "svc_user@MY.DOMAIN.COM", "svc_user", "a@b/c", "", None]
    assert apply(given, text.principal_user) == ["svc_user", "svc_user", "svc_user", "a", "", None]


def test_default_principal_user(apply):
    listing = "Ticket cache: FILE:/tmp/x\nDefault principal: svc/h@D\n\nValid starting"
    assert apply([listing, "none", "Default", "Default x"], text.default_principal_user) == [
        "svc", "", "Default", "",
    ]


def test_mask(rows):
    data = [("a.b axb a.b", "a.b"), ("abc", "z"), ("abc", None), ("abc", ""), (None, "x"), ("$1(", "$1(")]
    found = [r[0] for r in rows(data, "t string, s string").select(text.mask("t", "s")).collect()]
    hidden = "<<MASKED TOKEN>>"
    assert found == [f"{hidden} axb {hidden}", "abc", "abc", "abc", None, hidden]


def test_split_host_port(apply):
    given = ["http://h:8998", "http://h", "h", "a:b:", "é:1", ":"]
    found = [tuple(r) for r in apply(given, text.split_host_port)]
    assert found == [
        ("http://h", "8998", "ok"), ("http", "//h", "ok"), (None, None, "no_port"),
        ("a:b", "", "ok"), ("é", "1", "ok"), ("", "", "ok"),
    ]
    with pytest.raises(Exception, match="no colon"):
        apply(["h"], lambda url: text.split_host_port(url, strict=True))


def test_parse_kv(rows):
    data = [(["a=1", "b=x=y", "a=2"],), (["a=", "=v"],), (["a"],), ([],), (None,)]
    items = rows(data, "items array<string>")
    found = [tuple(r[0]) for r in items.select(text.parse_kv("items")).collect()]
    assert found == [
        ({"a": "2", "b": "x=y"}, "ok"), ({"a": "", "": "v"}, "ok"), (None, "no_equals"), ({}, "ok"), (None, "ok"),
    ]
    with pytest.raises(Exception, match="no ="):
        items.select(text.parse_kv("items", strict=True)["status"]).collect()


def test_merge_conf(rows):
    data = [({"a": "1", "b": "1"}, {"b": "2", "c": "2"}, {"c": "3", "spark.logConf": "no"}), (None, None, None)]
    maps = rows(data, "x map<string,string>, y map<string,string>, z map<string,string>")
    found = [r[0] for r in maps.select(text.merge_conf("x", "y", "z")).collect()]
    assert found == [{"a": "1", "b": "2", "c": "3", "spark.logConf": "true"}, {"spark.logConf": "true"}]
    assert maps.select(text.merge_conf("x", log_conf=False)).collect()[1][0] == {}


def test_request_json(rows):
    df = rows([("f", None, [], {"k": "v"})], "file string, name string, args array<string>, conf map<string,string>")
    found = df.select(text.request_json("file", "name", "args", "conf")).first()[0]
    assert json.loads(found) == {"file": "f", "args": [], "conf": {"k": "v"}}


def test_json_get(apply):
    given = ['{"a": {"b": "x"}}', '{"a": {}}', "{}", None, '{"a": {"b": null}}']
    assert apply(given, lambda c: text.json_get(c, "$.a.b", "d")) == ["x", "d", "d", "d", "d"]
    assert apply(given, lambda c: text.json_get(c, "$.a.b"))[1] is None


ARTIFACTS = [
    # kind, uri, action, output
    ("env", "hdfs:///u/e/env.tar.gz#CONDA", "pass", "hdfs:///u/e/env.tar.gz#CONDA"),
    ("archive", "S3://b/k", "pass", "S3://b/k"),
    ("archive", "/home/u/env.tar.gz#CONDA", "upload", f"hdfs://{RUN}/env.tar.gz#CONDA"),
    ("env", "/home/u/env.tar.gz#CONDA", "upload", f"hdfs://{RUN}/env.tar.gz#CONDA"),
    ("archive", "/home/u/a.zip", "upload", f"hdfs://{RUN}/a.zip"),
    ("archive", "/home/u/a.zip#", "upload", f"hdfs://{RUN}/a.zip"),
    ("archive", "/home/u/a#b#c", "upload", f"hdfs://{RUN}/a#b#c"),
    ("archive", "/home/my env.zip", "upload", f"hdfs://{RUN}/my env.zip"),
    ("archive", "/a/b/", "upload", f"hdfs://{RUN}/"),
    ("archive", "ftp://h/x", "reject", None),
    ("env", "file:/x#y", "reject", None),
    ("file", "/home/u/main.py", "upload", f"{RUN}/main.py"),
    ("pyFile", "/home/u/lib.py#x", "upload", f"hdfs://{RUN}/lib.py#x"),
    ("pyFile", "ftp://h/lib.py", "upload", f"hdfs://{RUN}/lib.py"),
]


def test_resolve_artifact(rows):
    df = rows([row[:2] for row in ARTIFACTS], "kind string, uri string")
    found = df.select(artifacts.resolve_artifact("kind", "uri", F.lit(RUN))).collect()
    assert [(r[0].action, r[0].output) for r in found] == [row[2:] for row in ARTIFACTS]
    assert found[2][0].symlink == "CONDA" and found[5][0].symlink is None
    assert found[6][0].base == "/home/u/a#b#c"
    with pytest.raises(Exception, match="no hdfs, s3 or local path: f"):
        df.select(artifacts.resolve_artifact("kind", "uri", F.lit(RUN), strict=True)["output"]).collect()


def test_env_python(apply):
    given = {
        "hdfs:///u/e/env.tar.gz#CONDA": "CONDA", "/home/u/env.tar.gz": "env.tar.gz", "env.zip#": "env.zip",
        "/a/b/": "", "/a#b#c": "b#c", "hdfs://host": "", "s3://h/x.zip?v=1#": "x.zip", "/a/x;v=1": "x",
        "hdfs:///a/x;v=1": "x;v=1", "hdfs:env.zip": "env.zip",
    }
    assert apply(given, artifacts.env_python) == [f"./{root}/bin/python" for root in given.values()]


def test_config_scan(spark, tmp_path):
    full = {
        "kernel_python_credentials": {"url": "http://h:8998", "auth": "x"},
        "session_configs": {"driverMemory": "1000M", "executorCores": 2, "conf": {"spark.a": "1"}},
        "other": [1],
    }
    bare = {"session_configs": {"driverMemory": "1g"}}
    for name, config in {"full": full, "bare": bare, "empty": {}}.items():
        (tmp_path / f"{name}.json").write_text(json.dumps(config, indent=2))
    found = {r.path.rsplit("/", 1)[1]: r for r in config_scan(spark, str(tmp_path)).collect()}
    assert (found["full.json"].url, found["full.json"].port) == ("http://h", "8998")
    settings = found["full.json"].session_configs
    assert json.loads(settings.pop("conf")) == {"spark.a": "1"}
    assert settings == {"driverMemory": "1000M", "executorCores": "2"}
    assert (found["bare.json"].url, found["bare.json"].port) == (None, None)
    assert found["bare.json"].session_configs == {"driverMemory": "1g"}
    assert found["empty.json"].session_configs == {}


def test_config_status(spark, tmp_path):
    texts = {
        "ok": '{"kernel_python_credentials": {"url": "http://h:1"}}',
        "no_port": '{"kernel_python_credentials": {"url": "h"}, "session_configs": {"a": "1"}}',
        "no_credentials": '{"session_configs": {"a": "1"}}',
        "malformed": '{"kernel_python_credentials": {"url": "http://h',
    }
    for name, text in texts.items():
        (tmp_path / f"{name}.json").write_text(text)
    found = {r.path.rsplit("/", 1)[1].removesuffix(".json"): r for r in config_scan(spark, str(tmp_path)).collect()}
    assert {name: row.status for name, row in found.items()} == {name: name for name in texts}
    assert found["no_port"].address == "h" and found["no_port"].url is None
    assert found["no_port"].session_configs == {"a": "1"} and found["malformed"].session_configs == {}
    for name in ("no_port", "malformed"):
        with pytest.raises(Exception, match=f"configuration is {name}"):
            config_scan(spark, str(tmp_path / f"{name}.json"), strict=True).collect()
    assert config_scan(spark, str(tmp_path / "no_credentials.json"), strict=True).count() == 1


def test_layers_merge_conf_entry_by_entry(rows):
    docs = rows(
        [(1, '{"session_configs": {"conf": {"spark.a": "1", "spark.b": "2"}, "driverMemory": "1g"}}',
          '{"conf": {"spark.b": "3"}, "driverMemory": "2g", "archives": ["x.zip"]}', 4, ["spark.c=5=6"])],
        "job long, low string, tool string, executorCores int, items array<string>",
    )
    layers = (
        config_layer(config_rows(docs, "low", "job"), "job")
        .unionByName(tool_layer(tool_rows(docs, "tool", "job"), "job"))
        .unionByName(command_layer(docs, "job", ["executorCores"], "items"))
    )
    row = submissions(overlay(layers)).first()
    assert row.conf == {"spark.a": "1", "spark.b": "3", "spark.c": "5=6"}
    assert (row.driverMemory, row.executorCores, row.archives, row.file) == ("2g", 4, ["x.zip"], None)
    assert submissions(overlay(layers.limit(0))).count() == 0
    assert tool_rows(docs, F.lit("{oops"), "job").first().status == "malformed"


def test_config_scan_of_missing_path(spark, tmp_path):
    missing = str(tmp_path / "does-not-exist")
    assert config_scan(spark, missing).collect() == []
    (tmp_path / "a.json").write_text("{}")
    assert config_scan(spark, [missing, str(tmp_path / "a.json")]).count() == 1


def test_config_to_overlay(rows, spark):
    docs = rows(
        [(1, '{"session_configs": {"driverMemory": "1000M", "executorCores": 2},'
             ' "kernel_python_credentials": {"url": "http://h:1"}}')],
        "job long, doc string",
    )
    low = config_layer(config_rows(docs, "doc", "job"), "job")
    tool = {"driverMemory": "4g", "driverCores": "2", "executorMemory": "2g", "executorCores": "1"}
    higher = rows(
        [(1, 1, i, k, v) for i, (k, v) in enumerate(tool.items())] + [(1, 2, 0, "driverCores", "8")],
        "job_id long, layer int, seq int, key string, value string",
    )
    found = {r.key: r.value for r in overlay(low.unionByName(higher)).collect()}
    assert found == tool | {"driverCores": "8", "server_url": "http://h", "server_port": "1"}


def test_overlay_nulls(rows):
    data = [
        (1, 0, 0, "a", "low"), (1, 1, 0, "a", None), (1, 2, 0, "a", None),
        (1, 0, 0, "b", "low"), (1, 2, 0, "b", None), (1, 2, 1, "c", "x"), (1, 2, 2, "c", "y"),
    ]
    found = overlay(rows(data, "job_id long, layer int, seq int, key string, value string"))
    assert {r.key: r.value for r in found.collect()} == {"a": None, "b": "low", "c": "y"}


def test_submission_requests(rows):
    schema = (
        "file string, name string, driverMemory string, driverCores int, executorMemory string,"
        " executorCores int, numExecutors int, archives array<string>, queue string,"
        " conf map<string,string>, args array<string>, pyFiles array<string>, conda_env string"
    )
    rest = (None,) * 5
    data = [
        ("/h/pi.py", "n", *rest, ["/h/a.zip#A", "s3://b/c"], None, {"spark.a": "1"}, ["100"], ["/h/l.py"], "/h/e.zip#E"),
        ("/h/pi.py", None, *rest, None, None, None, None, None, "hdfs:///e.zip"),
        ("/h/pi.py", None, *rest, ["ftp://x/y#z"], None, None, None, None, None),
    ]
    found = submission_requests(rows(data, schema), F.lit(RUN)).collect()
    python = "./E/bin/python"
    assert json.loads(found[0].request) == {
        "file": f"{RUN}/pi.py", "name": "n", "args": ["100"], "pyFiles": [f"hdfs://{RUN}/l.py"],
        "archives": [f"hdfs://{RUN}/a.zip#A", "s3://b/c", f"hdfs://{RUN}/e.zip#E"],
        "conf": {"spark.a": "1", "spark.logConf": "true", "spark.pyspark.python": python,
                 "spark.yarn.appMasterEnv.PYSPARK_PYTHON": python},
    }
    second = json.loads(found[1].request)
    assert second["archives"] == ["hdfs:///e.zip"] and "pyFiles" not in second
    assert found[2].request is None and found[2].rejected == ["ftp://x/y#z"]


def test_env_python_agrees_with_url_parsing(apply):
    rng = random.Random(11)
    pieces = ["hdfs", "s3", "S3", "file", "a", "b.zip", ":", "/", "//", "#", "?", ";", "=", ".", " ", "@", "-1"]
    uris = ["".join(rng.choices(pieces, k=rng.randint(0, 7))).strip() for _ in range(3000)]
    expected = []
    for uri in uris:
        parsed = urlparse(uri)
        root = parsed.fragment or os.path.basename(parsed.path)
        # Only what an environment may be: on the cluster, or local.
        expected.append(f"./{root}/bin/python" if parsed.scheme in ("", "hdfs", "s3") else None)
    schemes = [urlparse(uri).scheme for uri in uris]
    assert apply(uris, artifacts.scheme) == schemes
    wrong = [
        (uri, found, wanted)
        for uri, found, wanted in zip(uris, apply(uris, artifacts.env_python), expected)
        if wanted is not None and found != wanted
    ]
    assert wrong == []


def test_splits_agree_with_python(apply):
    rng = random.Random(12)
    texts = ["".join(rng.choices("ab:=@/é ", k=rng.randint(0, 8))) for _ in range(2000)]
    for text_, found in zip(texts, apply(texts, text.split_host_port)):
        parts = text_.rsplit(":", maxsplit=1)
        assert tuple(found)[:2] == (tuple(parts) if len(parts) == 2 else (None, None))
    for text_, found in zip(texts, apply(texts, lambda c: text.parse_kv(F.array(c)))):
        assert found.conf == (dict([text_.split("=", maxsplit=1)]) if "=" in text_ else None)
    users = [text_.split("@")[0].split("/")[0] for text_ in texts]
    assert apply(texts, text.principal_user) == users
    masked = [text_.replace("a:", text.MASK) for text_ in texts]
    assert apply(texts, lambda c: text.mask(c, F.lit("a:"))) == masked
