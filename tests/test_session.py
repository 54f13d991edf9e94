from types import SimpleNamespace

import pytest

from voltlake.session import side_by_side, work_dir


def session(master, conf_dir=None):
    state = {"dir": None}
    return SimpleNamespace(
        conf=SimpleNamespace(get=lambda name, default: conf_dir),
        sparkContext=SimpleNamespace(
            master=master,
            getCheckpointDir=lambda: state["dir"],
            setCheckpointDir=lambda d: state.update(dir=d),
        ),
    )


def test_the_clusters_shared_folder_is_used_and_every_call_gets_its_own():
    spark = session("yarn", "hdfs://shared/cp/")
    first, second = work_dir(spark, "a"), work_dir(spark, "a")
    assert first.startswith("hdfs://shared/cp/a-") and first != second


def test_a_cluster_without_the_setting_is_refused():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        work_dir(session("yarn"), "a")


def test_a_local_session_falls_back_to_one_temporary_folder():
    spark = session("local[2]")
    assert work_dir(spark, "a").rsplit("/", 1)[0] == work_dir(spark, "b").rsplit("/", 1)[0]


def test_jobs_side_by_side_all_finish_before_a_failure_is_raised(spark):
    done = []

    def count(n):
        done.append(spark.range(n).count())
        return done[-1]

    def fail():
        raise ValueError("no")

    assert side_by_side(spark, {"a": lambda: count(3), "b": lambda: count(5)}) == {"a": 3, "b": 5}
    done.clear()
    with pytest.raises(ValueError):
        side_by_side(spark, {"x": fail, "a": lambda: count(3), "b": lambda: count(5)})
    assert sorted(done) == [3, 5]
