from types import SimpleNamespace

import pytest

from pagemill import session


def stand_in(setting, master):
    conf = SimpleNamespace(get=lambda key, default=None: setting if key == "spark.checkpoint.dir" else default)
    context = SimpleNamespace(master=master, applicationId=f"app-{master}", getConf=lambda: conf)
    return SimpleNamespace(conf=conf, sparkContext=context)


def test_shared_folder_comes_from_the_session():
    spark = stand_in("/shared/work/", "spark://host:7077")
    assert session.shared_dir(spark) == "/shared/work"
    assert session.new_table_path(spark, "t").startswith("/shared/work/t-")
    assert session.new_table_path(spark, "t") != session.new_table_path(spark, "t")


def test_only_a_local_master_may_leave_it_unset():
    with pytest.raises(ValueError):
        session.shared_dir(stand_in(None, "spark://host:7077"))
    local = stand_in(None, "local[2]")
    assert session.shared_dir(local) == session.shared_dir(local)
