import importlib.abc
import sys
from types import SimpleNamespace

import pytest

import __spark_entry__ as entry
from postloom import session


def fake(master, named=None):
    none = SimpleNamespace(isDefined=lambda: False)
    sc = SimpleNamespace(master=master, _jsc=SimpleNamespace(sc=lambda: SimpleNamespace(getCheckpointDir=lambda: none)), getConf=lambda: {})
    return SimpleNamespace(sparkContext=sc, conf={"spark.checkpoint.dir": named} if named else {})


def test_no_local_folder_on_a_cluster():
    with pytest.raises(RuntimeError):
        session.ensure_checkpoint_dir(fake("spark://host:7077"))


def test_written(spark):
    df = spark.createDataFrame([(1, "a"), (2, None)], "x int, y string")
    back = session.written(df)
    assert sorted(tuple(r) for r in back.collect()) == [(1, "a"), (2, None)] and session.written(df.limit(0)).count() == 0
    path = back.inputFiles()[0].rpartition("/")[0]
    assert session.has_path(spark, path)
    session.discard(back)
    assert not session.has_path(spark, path)
    session.drop_path(spark, path)  # nothing to do


class Blocked(importlib.abc.MetaPathFinder):
    def find_spec(self, name, path=None, target=None):
        if name == "ahocorasick":
            raise ImportError(name)


def test_entry_without_a_library_of_training_data(monkeypatch):
    gone = [m for m in sys.modules if m == "ahocorasick" or m.startswith("postloom.llm")]
    for m in gone:
        monkeypatch.delitem(sys.modules, m)
    monkeypatch.setattr(sys, "meta_path", [Blocked(), *sys.meta_path])
    assert "reject_reason_counts" in entry.queries()
