"""Where intermediate tables go."""

from types import SimpleNamespace

import pytest

from stockpulse import session


def fake(master: str, configured: str | None):
    return SimpleNamespace(conf=SimpleNamespace(get=lambda key, default=None: configured if key == "spark.checkpoint.dir" else default),
                           sparkContext=SimpleNamespace(master=master, applicationId="app-1"))


def test_the_named_folder_is_used():
    assert session.shared_dir(fake("yarn", "hdfs:///shared/")) == "hdfs:///shared"
    assert session.shared_dir(fake("local[2]", "/shared")) == "/shared"
    assert session.scratch_path(fake("yarn", "hdfs:///shared"), "x").startswith("hdfs:///shared/stockpulse/x-")


def test_a_cluster_needs_the_setting():
    with pytest.raises(RuntimeError):
        session.shared_dir(fake("yarn", None))


def test_local_mode_gets_one_folder_per_session():
    first = session.shared_dir(fake("local[2]", None))
    assert first == session.shared_dir(fake("local[2]", None))


def test_stage_and_attach(spark):
    staged = session.stage(spark.range(5), "t")
    assert staged.count() == 5
    one = staged.selectExpr("max(id) AS top", "min(id) AS low")
    assert [tuple(r) for r in session.attach_row(staged.filter("id = 3"), one).collect()] == [(3, 4, 0)]
