"""Interim tables that later joins read without a shuffle (S7, S4 for J2, J6).

The dense tables are joined on district and week, and on district alone, by several
figures.  Written as plain files they are shuffled again for each of these joins.  Here a
table is dealt into buckets by its district once, when it is written; joins and
aggregations whose keys contain the district then start from the buckets.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame

from ..session import scratch_path


def write_clustered(df: DataFrame, name: str, keys: Sequence[str], sort: Sequence[str] = (), buckets: int | None = None,
                    path: str | None = None) -> DataFrame:
    """``df`` stored in buckets by ``keys``, sorted by ``keys`` and ``sort``, and read back.

    ``buckets`` (default: the session's shuffle partitions) must agree, or be a multiple,
    between tables that are to be joined.  The rows are dealt by the same hash before the
    write, so each bucket is one file.  The table is an external one under ``path`` (default:
    a scratch folder below ``spark.checkpoint.dir``) with a name of its own in the session's
    catalog.  A bucket is read by one task: this is for tables with about equally many rows
    to a key, as dense series have; event tables with hot keys are counted first.

    From then on the session lets a join on more columns than ``keys`` use the buckets
    (``spark.sql.requireAllClusterKeysForCoPartition`` off; results do not depend on it).
    NULL keys are kept, in one bucket; an empty table gives an empty table.
    """
    spark = df.sparkSession
    spark.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    table = f"epigrid_{name}_{uuid.uuid4().hex}".replace("-", "_")
    order = [*keys, *sort]
    (df.repartition(buckets, *keys).write.format("parquet").option("path", path or scratch_path(spark, f"clustered-{name}"))
       .bucketBy(buckets, *keys).sortBy(*order).saveAsTable(table))
    return spark.table(table)
