import os
import re

import pytest

from jobledger.operators import sampling
from jobledger.plans.session import fresh_dir, shared_dir
from jobledger.sources import ranges, staging


def test_ranges(spark):
    numbers = ranges.number_range(spark)
    assert (numbers.count(), numbers.rdd.getNumPartitions()) == (200_000, 2)
    assert numbers.selectExpr("min(id)", "max(id)").first() == (1, 200_000)
    slices = ranges.range_slices(spark)
    assert (slices.count(), slices.rdd.getNumPartitions()) == (1000, 100)


def test_mc_ratio(spark, rows):
    points = rows([(0.0, 1.0), (1.0, 1.0), (0.5, 0.5), (-1.0, 0.0)], "x double, y double")
    assert tuple(sampling.mc_ratio(points).first()) == (3, 4, 3.0)
    estimate = sampling.mc_ratio(sampling.uniform_points(ranges.number_range(spark), seed=7)).first()
    assert estimate.n == 200_000 and abs(estimate.ratio - 3.14159) < 0.02


def test_worker_inventory(spark):
    slices = ranges.range_slices(spark, 100, 10)
    facts = sampling.worker_facts(slices, ["pandas", "numpy"]).collect()
    assert sum(fact.elements for fact in facts) == 100
    found = sampling.worker_inventory(slices, ["pandas", "numpy"]).collect()
    assert len(found) == len({fact.info for fact in facts}) == 1
    assert len(found[0].info.split(",")) == 4
    with pytest.raises(Exception, match="no_such_library"):
        sampling.worker_inventory(slices, ["no_such_library"]).collect()


def test_daily_counts(rows):
    data = rows([("2024-01-01 00:00:00",), ("2024-01-01 23:59:59",), ("2024-01-02 00:00:00",)], "at string")
    found = sampling.daily_counts(data.selectExpr("cast(at AS timestamp_ntz) AS ts"), "ts").collect()
    assert sorted((str(r.day), r.n) for r in found) == [("2024-01-01", 2), ("2024-01-02", 1)]


def test_staged_write(spark, rows, tmp_path):
    df = rows([(1,), (2,)], "n int")
    path = staging.staged_write(df, "svc", root=str(tmp_path))
    assert re.fullmatch(re.escape(str(tmp_path)) + r"/svc/staged-files/[0-9a-f]{6}_\d+", path)
    assert staging.staged_write(df.limit(1), "svc", directory=path) == path
    assert spark.read.parquet(path).count() == 1
    assert staging.run_directory("u").startswith("/user/u/staged-files/")


def test_shared_dir_is_stable(spark):
    assert shared_dir(spark) == shared_dir(spark)
    assert os.path.dirname(fresh_dir(spark, "a")) == shared_dir(spark)
    assert fresh_dir(spark, "a") != fresh_dir(spark, "a")
