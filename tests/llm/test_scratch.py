"""Scratch tables belong to a run or to the application, and go with it."""

import os
from types import SimpleNamespace

import pytest

from cohortlens.llm import exact_dedup, simhash
from cohortlens.llm.common import local_scratch, remove_scratch, scratch_folder, scratch_run


def files(folder):
    return [os.path.join(top, name) for top, _, names in os.walk(folder) for name in names]


def test_a_run_leaves_nothing(spark, docs):
    with scratch_run(spark) as folder:
        assert exact_dedup.exact_duplicates(docs).count() == docs.count()
        with scratch_run(spark) as inner:
            assert simhash.near_duplicates(docs).count() == docs.count()
            assert inner.startswith(folder) and files(inner)
        assert files(folder) and not os.path.exists(inner)
        with pytest.raises(ZeroDivisionError), scratch_run(spark) as failed:
            exact_dedup.exact_duplicates(docs)
            1 / 0
        assert not os.path.exists(failed)
        remove_scratch(spark)
        assert not os.path.exists(folder)
        exact_dedup.exact_duplicates(docs)
        assert files(folder)
    assert not os.path.exists(folder)
    assert spark.sparkContext.applicationId in scratch_folder(spark)


def session(master, folder=None):
    conf = SimpleNamespace(get=lambda key, default=None: folder or default)
    return SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master=master, applicationId="app"))


def test_only_a_local_session_has_a_temporary_folder():
    assert scratch_folder(session("local[4]")) == f"{local_scratch()}/llm-app"
    for master in ("yarn", "local-cluster[2,1,1000]"):
        assert scratch_folder(session(master, "/shared/x/")) == "/shared/x/llm-app"
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            scratch_folder(session(master))
