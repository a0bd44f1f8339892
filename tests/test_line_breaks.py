"""Records with line breaks are put together where they are read."""

import csv
import io as pyio
import random

import pytest

from epigrid.session import scratch_path
from epigrid.sources import io


def write_text(spark, folder, name, text):
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path(f"{folder}/{name}")
    stream = path.getFileSystem(conf).create(path, True)
    stream.write(bytearray(text.encode()))
    stream.close()


@pytest.mark.parametrize("split,batch", [(1 << 20, 10_000), (1 << 20, 3), (90, 10_000), (90, 2)])
def test_records_across_batches_and_splits(spark, split, batch):
    random.seed(split + batch)
    folder, want = scratch_path(spark, "t-batches"), []
    for name in ("a.txt", "b.txt", "open.txt"):
        rows = [(f"{name}{k}", random.choice(["x", 'say "no"', "two\nlines", "\n\n" + "long line\n" * random.randint(1, 30), "\n"])) for k in range(60)]
        out = pyio.StringIO()
        csv.writer(out, quoting=csv.QUOTE_ALL, lineterminator="\n").writerows(rows)
        text = "title\n" + out.getvalue()
        if name == "open.txt":      # a quote that is never closed holds the rest of its file
            text += '"end","never\n' + "closed\n" * 40
            rows.append(("end", "never\n" + "closed\n" * 39 + "closed"))
        write_text(spark, folder, name, text)
        want += rows
    given = {"spark.sql.files.maxPartitionBytes": split, "spark.sql.files.openCostInBytes": 1, "spark.sql.execution.arrow.maxRecordsPerBatch": batch}
    for key, value in given.items():
        spark.conf.set(key, value)
    try:
        lines = io._without_first(io._numbered_lines(spark, folder), 1)
        got = [r.value for r in io.quoted_records(lines).collect()]
    finally:
        for key in given:
            spark.conf.unset(key)
    cells = [next(csv.reader(pyio.StringIO(v, newline=""))) for v in got]
    assert sorted(tuple(c) for c in cells) == sorted(want)


def test_lines_with_breaks_are_not_shuffled(spark):
    folder = scratch_path(spark, "t-still")
    write_text(spark, folder, "a.csv", "id;cell\n" + "".join(f'{k};"one\ntwo"\n' for k in range(500)))
    df = io.read_delimited(spark, folder, "ic", sep=";", quoted_breaks=True)
    assert df.count() == 500 and df.where("cell = 'one\ntwo'").count() == 500
    assert "hashpartitioning" not in df._jdf.queryExecution().toString()
