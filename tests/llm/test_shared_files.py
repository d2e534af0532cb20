"""Committed files: second attempts, stopped attempts, stores that don't replace."""

import os

import pytest

from pairforge.llm.shared_files import CommittedFile, drop_temporary, open_stream


def put(root, name, data):
    f = CommittedFile(root, name)
    f.write(data)
    f.commit()


def test_a_second_attempt_takes_the_first_ones_place(tmp_dir):
    put(tmp_dir, "a", b"same")
    late = CommittedFile(tmp_dir, "a")
    late.write(b"same")
    assert open_stream(tmp_dir, "a").read() == b"same"  # there while the second attempt runs
    late.commit()
    assert open_stream(tmp_dir, "a").read() == b"same"
    stopped = CommittedFile(tmp_dir, "a")
    stopped.write(b"sa")  # never committed
    assert open_stream(tmp_dir, "a").read() == b"same"
    drop_temporary(tmp_dir)
    assert os.listdir(tmp_dir) == ["a"]


def test_a_store_that_does_not_rename_onto_files(tmp_dir, monkeypatch):
    put(tmp_dir, "a", b"same")
    second = CommittedFile(tmp_dir, "a")
    second.write(b"same")

    class Strict:
        def move(self, a, b):
            raise OSError("destination exists")

        def get_file_info(self, path):
            return self.inner.get_file_info(path)

    strict = Strict()
    strict.inner, second.fs = second.fs, strict
    second.commit()  # the first attempt's file stays
    assert open_stream(tmp_dir, "a").read() == b"same"
    third = CommittedFile(tmp_dir, "b")
    third.fs = strict
    with pytest.raises(OSError):
        third.commit()
