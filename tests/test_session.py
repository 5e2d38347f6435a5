from types import SimpleNamespace

import pytest

from docgate import session


def test_scratch_data_goes_to_the_configured_folder(spark):
    assert session.shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")


def test_a_cluster_must_name_its_shared_folder():
    cluster = SimpleNamespace(
        conf=SimpleNamespace(get=lambda key, default=None: default),
        sparkContext=SimpleNamespace(master="spark://somewhere:7077"),
    )
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_dir(cluster)


def test_inputs_with_enough_splits_are_not_shuffled(spark, plan):
    enough = spark.range(0, 100, 1, 8)
    assert session.spread(enough, "id") is enough
    assert "hashpartitioning" in plan(session.spread(spark.range(0, 100, 1, 1), "id"))


def test_reliable_frames_have_no_lineage(spark, plan):
    df = session.reliable(spark.range(10).selectExpr("id * 2 AS twice"))
    assert "Range" not in plan(df)
    assert df.count() == 10
