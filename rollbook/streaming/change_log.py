"""The state of many keys as a base and a log of changes.

A batch appends the rows of the keys that it changes, whole, as a part of the log. The newest row of a key counts, so a read
is one aggregate with a map-side combine. Short logs are put together; a log that has grown to a share of the base is merged
into a new base, whose number of hash ranges follows from its rows. So what is written is in proportion to what changes.
"""

import math

from pyspark.sql import functions as F

from ..sources.versions import Part, current_version, publish, to_merge, write_part

#: Parts of the log that become one, the share of the base at which the log is merged into it, and rows of a hash range.
MOST_LOGS, SHARE, RANGE_ROWS = 8, 0.25, 1_000_000


def _range(key, ranges):
    return F.pmod(F.xxhash64(key), F.lit(int(ranges)))


class ChangeLog:
    """Rows by ``key`` in ``folder``; ``schema`` is the DDL of the rows without partition columns."""

    def __init__(self, spark, folder, key, schema, most_logs=MOST_LOGS, share=SHARE, range_rows=RANGE_ROWS):
        self.spark, self.folder, self.key, self.schema = spark, folder, key, schema
        self.most_logs, self.share, self.range_rows = most_logs, share, range_rows
        self.columns = spark.createDataFrame([], schema).columns

    def _read(self, parts, keys=None):
        """Newest row per key of some parts; with ``keys`` of these only, and of the hash ranges that they lie in."""
        out = None
        for age, r in enumerate(parts):
            path = f"{self.folder}/{r.part}"
            if r.kind == "base":
                one = self.spark.read.schema(f"{self.schema}, `range` bigint").parquet(path)
                if keys is not None:
                    # the base is laid out in as many ranges as its part's name says
                    ranges = int(r.part.rpartition("-")[2])
                    touched = keys.select(_range(self.key, ranges).alias("range")).distinct()
                    one = one.join(touched, "range", "left_semi")
            else:
                one = self.spark.read.schema(self.schema).parquet(path)
            one = one.select(*self.columns, F.lit(age).alias("_age"))
            out = one if out is None else out.unionByName(one)
        if out is None:
            return self.spark.createDataFrame([], self.schema)
        if keys is not None:
            out = out.join(keys.select(self.key).distinct(), self.key, "left_semi")
        rest = [c for c in self.columns if c != self.key]
        newest = out.groupBy(self.key).agg(F.max_by(F.struct(*rest), "_age").alias("_row"))
        return newest.select(self.key, *[F.col(f"_row.{c}").alias(c) for c in rest]).select(*self.columns)

    def read(self, keys=None, before=None):
        """Rows as they are now or were before a version; with ``keys``, a table with the key column, only theirs."""
        _, parts = current_version(self.spark, self.folder, before)
        return self._read(parts, keys)

    def append(self, rows, version):
        """Store the rows of changed keys as a version; the same version again replaces what it had written.

        The version is built on the newest one below it, so a batch that runs again starts from the same state.
        """
        _, parts = current_version(self.spark, self.folder, version)
        name = f"log/{version:010d}"
        base = [p for p in parts if p.kind == "base"]
        logs = [p for p in parts if p.kind == "log"]
        logs.append(Part("log", name, write_part(rows.select(*self.columns), self.folder, name)))
        in_base, in_logs = (sum(p.n_rows for p in x) for x in (base, logs))
        if len(logs) > self.most_logs and in_logs >= self.share * in_base:
            base, logs = [self._merged([*base, *logs], in_base + in_logs, version)], []
        elif len(logs) > self.most_logs:
            # the short logs become one, so that a read has few parts
            kept, short = to_merge(logs, self.most_logs)
            merged = f"log/{version:010d}-merged"
            logs = [*kept, Part("log", merged, write_part(self._read(short), self.folder, merged))]
        publish(self.spark, self.folder, version, [*base, *logs])

    def _merged(self, parts, most, version):
        ranges = max(1, math.ceil(most / self.range_rows))
        name = f"base/{version:010d}-{ranges}"
        rows = self._read(parts).withColumn("range", _range(self.key, ranges))
        # a range is some tasks' work, however many rows its keys have; sorted rows let a reader skip row groups
        rows = rows.repartition("range").sortWithinPartitions("range", self.key)
        return Part("base", name, write_part(rows, self.folder, name, "range"))
