from __future__ import annotations

import pytest

from chatlens.llm.staging import scratch, stage


def folders(df) -> set[str]:
    return {f.rsplit("/", 1)[0] for f in df.inputFiles()}


def test_tables_of_a_block_go_at_its_end(spark):
    with scratch(spark):
        inner = stage(spark.range(5))
        with scratch(spark):
            passed_on = stage(inner.where("id > 1"), keep=True)
        assert passed_on.count() == 3
        kept = stage(passed_on.where("id > 2"), keep=True)
    assert sorted(r["id"] for r in kept.collect()) == [3, 4]
    for gone in (inner, passed_on):
        with pytest.raises(Exception, match="FILE_NOT_EXIST|does not exist"):
            gone.count()


def test_they_go_after_a_failure_too(spark):
    with pytest.raises(KeyError), scratch(spark):
        inner = stage(spark.range(5))
        raise KeyError
    with pytest.raises(Exception, match="FILE_NOT_EXIST|does not exist"):
        inner.count()
