"""File fingerprints against hashlib over the same files."""

import hashlib
import os

import pytest

from entitymill.operators.history import file_fingerprints

CONTENT = {
    "plain.csv": b"a,b\n1,2\n",
    "open_end.csv": b"a,b\n1,2",
    "empty.csv": b"",
    "one_feed.csv": b"\n",
    "feeds.csv": b"\n\n\nx\n\n",
    "windows.csv": b"a\r\nb\r\n",
    "no_utf8.csv": b"\xff\xfe\x80\n\x00a\xc3\n",
    "copy.csv": b"a,b\n1,2\n",
    "long.csv": b"".join(b"%d,%s\n" % (i, b"x" * (i % 97)) for i in range(60_000)),
    "long_open.csv": b"\n".join(b"%d" % (i % 7) for i in range(80_000)),
}


@pytest.mark.parametrize("split", ["128m", "64k"])
def test_file_fingerprints(spark, tmp_path, split):
    for name, content in CONTENT.items():
        (tmp_path / name).write_bytes(content)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        got = {os.path.basename(r["path"]): (r["file_hash"], r["size_bytes"], r["row_count"])
               for r in file_fingerprints(spark, str(tmp_path)).collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert got == {
        name: (hashlib.sha256(c).hexdigest(), len(c), c.count(b"\n") + (c != b"" and not c.endswith(b"\n")))
        for name, c in CONTENT.items() if c  # Spark's readers pass over empty files
    }


def test_folder_of_empty_files(spark, tmp_path):
    (tmp_path / "nothing.csv").write_bytes(b"")
    assert file_fingerprints(spark, str(tmp_path)).count() == 0
