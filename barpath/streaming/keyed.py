"""A table in hash buckets of its key, of which a batch rewrites only those it touches. SURVEY STM-2..6.

``<path>/data/batch=n/bucket=b`` holds what batch n made of bucket b. ``<path>/commits/n`` says which batch last wrote each
bucket; it is written after the data, so a table is what its last commit says. A batch that is run again starts from the commit
before its own, whatever it wrote the first time. What no one of the last two commits refers to is deleted: the older of them is
what the batch in flight would start from again.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Buckets of a table: fixed when it is made. More of them make a batch of few keys cheaper and a commit larger.
BUCKETS = 64


class KeyedTable:
    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], buckets: int = BUCKETS):
        self.spark, self.path, self.keys, self.buckets = spark, path, list(keys), buckets

    # The folder, by whatever file system its path names.

    def _path(self, *parts: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path("/".join([self.path, *parts]))

    def _fs(self):
        return self._path().getFileSystem(self.spark._jsc.hadoopConfiguration())

    def commits(self) -> list[int]:
        """The batches that are kept, rising."""
        folder = self._path("commits")
        names = [s.getPath().getName() for s in self._fs().listStatus(folder)] if self._fs().exists(folder) else []
        return sorted(int(n) for n in names if n.isdigit())

    def commit(self, n: int | None) -> dict:
        """{"buckets": number, "schema": DDL as JSON, "at": {bucket: batch}}."""
        if n is None:
            return {"buckets": self.buckets, "schema": None, "at": {}}
        text = self.spark._jvm.org.apache.hadoop.io.IOUtils.readFullyToByteArray(self._fs().open(self._path("commits", str(n))))
        return json.loads(bytes(text).decode("utf-8"))

    def _last(self, before: int | None) -> int | None:
        known = [n for n in self.commits() if before is None or n < before]
        return known[-1] if known else None

    # Rows.

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")

    def touched(self, rows: DataFrame) -> list[int]:
        """The buckets that rows belong to: as many numbers as there are buckets at most."""
        return sorted(r[0] for r in rows.select(self.bucket()).distinct().collect())

    def read(self, before: int | None = None, only: Iterable[int] | None = None) -> DataFrame | None:
        """The table, or some of its buckets, as the last batch (before batch ``before``) left it; None if there was none."""
        n = self._last(before)
        if n is None:
            return None
        c = self.commit(n)
        if c["buckets"] != self.buckets:
            raise ValueError(f"the table has {c['buckets']} buckets, not {self.buckets}")
        wanted = None if only is None else set(only)
        paths = [f"{self.path}/data/batch={m}/bucket={b}" for b, m in c["at"].items() if wanted is None or int(b) in wanted]
        schema = T.StructType.fromJson(json.loads(c["schema"]))
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def replace(self, n: int, touched: Iterable[int], rows: DataFrame) -> None:
        """Batch n: ``rows`` take the place of all rows of the touched buckets. They must belong there."""
        before = self.commit(self._last(n))
        data = rows.withColumn("bucket", self.bucket())
        # adaptive execution joins small buckets in a file each and splits those of very many rows
        data.hint("rebalance", "bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{self.path}/data/batch={n}")
        fs, new = self._fs(), self._path("data", f"batch={n}")
        there = {int(s.getPath().getName().split("=")[1]) for s in fs.listStatus(new) if s.getPath().getName().startswith("bucket=")}
        at = {int(b): m for b, m in before["at"].items()}
        for b in touched:
            at.pop(b, None)
        at |= dict.fromkeys(there, n)
        text = json.dumps({"buckets": self.buckets, "schema": rows.schema.json(), "at": at})
        part = self._path("commits", f"{n}.tmp")
        out = fs.create(part, True)
        out.write(bytearray(text.encode("utf-8")))
        out.close()
        fs.delete(self._path("commits", str(n)), False)
        fs.rename(part, self._path("commits", str(n)))
        self._clean(n)

    def _clean(self, n: int) -> None:
        """Delete what only commits older than the one before n refer to."""
        known = [m for m in self.commits() if m <= n]
        keep = known[-2:]
        live = {(str(b), m) for k in keep for b, m in self.commit(k)["at"].items()}
        for old in known[:-2]:
            for b, m in self.commit(old)["at"].items():
                if (str(b), m) not in live:
                    self._fs().delete(self._path("data", f"batch={m}", f"bucket={b}"), True)
            self._fs().delete(self._path("commits", str(old)), False)
