"""Published versions survive failed writes and later versions."""

import pytest

from pairforge.plans import build as B
from pairforge.sources.splits import read_splits, write_splits
from pairforge.sources.versions import NoVersionError, publish, resolve, versions
from tests.conftest import SF_SMALL


def counts(spark, folder):
    return {r["split"]: r["count"] for r in read_splits(spark, folder).groupBy("split").count().collect()}


def test_a_failed_write_leaves_the_old_version(spark, tmp_dir):
    out = f"{tmp_dir}/out"
    sources = B.default_sources(spark, SF_SMALL)
    first, second = (B.build_records(sources, val_ratio=r).records for r in (0.1, 0.3))
    assert publish(spark, out, lambda f: write_splits(first, f), "a tenth") == 1
    pinned = resolve(spark, out)
    want = counts(spark, pinned)

    def killed(folder):
        write_splits(second, folder)  # all of it is there, but the job dies before it is published
        raise KeyboardInterrupt

    with pytest.raises(KeyboardInterrupt):
        publish(spark, out, killed)
    assert resolve(spark, out) == pinned and counts(spark, resolve(spark, out)) == want
    assert publish(spark, out, lambda f: write_splits(second, f)) == 2
    assert counts(spark, pinned) == counts(spark, resolve(spark, out, 1)) == want  # readers of the old one go on
    assert counts(spark, resolve(spark, out)) != want
    assert sorted((r["version"], r["note"]) for r in versions(spark, out).collect()) == [(1, "a tenth"), (2, "")]


def test_readers_without_a_version(spark, tmp_dir):
    with pytest.raises(NoVersionError, match="no version in"):
        resolve(spark, tmp_dir)
    publish(spark, tmp_dir, lambda f: spark.range(3).write.parquet(f))
    with pytest.raises(NoVersionError, match="no version 7"):
        resolve(spark, tmp_dir, 7)
    with pytest.raises(ValueError, match="nothing was written"):
        publish(spark, tmp_dir, lambda f: None)
    assert spark.read.parquet(resolve(spark, tmp_dir)).count() == 3


def test_two_writers_at_once(spark, tmp_dir):
    """Both read the catalog before either has published."""
    inner = []

    def outer(folder):
        spark.range(1).write.parquet(folder)

    def racing(folder):
        inner.append(publish(spark, tmp_dir, outer))
        spark.range(2).write.parquet(folder)

    assert publish(spark, tmp_dir, racing) == 2 and inner == [1]
    assert versions(spark, tmp_dir).count() == 2


def test_build_into_versions(spark, tmp_dir):
    sources = B.default_sources(spark, SF_SMALL)
    B.run_build(spark, sources, tmp_dir, versioned=True)
    one = counts(spark, resolve(spark, tmp_dir))
    B.run_build(spark, sources, tmp_dir, val_ratio=0.5, versioned=True)
    assert counts(spark, resolve(spark, tmp_dir, 1)) == one != counts(spark, resolve(spark, tmp_dir))
