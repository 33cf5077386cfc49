"""Line deduplication over levelled sorted runs of line hashes.

A text's lines are its pieces between \\n (null or empty: one empty line). A line's key is the line without the ASCII
white space [\\x20\\x09-\\x0D] at both ends and with A-Z in lower case; keys of at least `min_chars` code points count.

`LineRuns` is the store: one table of (h, n_docs, last_doc), bucketed and sorted by h, the MD5 of the key, in which each run is
a partition. So runs are joined and merged bucket by bucket without an exchange. A batch is reduced to its own keys
(partial sums before the shuffle, so a line in a third of all documents costs a row per task) and merge-anti-joined with
the runs: keys never seen are entered as they are, known ones with their counts added to what the runs say. So the entry with
the greatest count is a key's state. When a level holds `fanout` runs they are merged into one of the next level, so
each key is rewritten log(batches) times. A manifest beside the runs lists them; `LineRuns.open` goes on from it.
"""

from __future__ import annotations

import json
import uuid
from functools import reduce
from hashlib import md5

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from .scratch import delete, materialise, put, release, shared_dir, unused, without
from .textkit import SPACES

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def line_keys(docs: DataFrame, min_chars: int = 40) -> DataFrame:
    """doc_id, h: a row for each different counted key of each row of docs."""
    line = F.split(F.coalesce("text", F.lit("")), "\n", -1)
    key = F.transform(line, lambda x: F.translate(F.btrim(x, F.lit(SPACES.decode())), UPPER, LOWER))
    keys = F.array_distinct(F.filter(key, lambda k: F.char_length(k) >= min_chars))
    return docs.select("doc_id", F.explode(keys).alias("key")).select("doc_id", F.unhex(F.md5("key")).alias("h"))


class LineRuns:
    """Sorted runs by level, in a folder that all executors share. add() takes the keys of documents that no earlier batch held."""

    def __init__(self, spark: SparkSession, buckets: int = 8, fanout: int = 3, path: str | None = None):
        self.spark, self.buckets, self.fanout = spark, buckets, fanout
        self.path = path or f"{shared_dir(spark)}/line-runs-{uuid.uuid4().hex}"
        self.table = f"line_runs_{uuid.uuid4().hex}"
        self.levels: list[list[str]] = []
        self.version, self.id_type = 0, "bigint"

    @classmethod
    def open(cls, spark: SparkSession, path: str) -> LineRuns:
        """The store as its last manifest says, perhaps written by another session."""
        last = max((json.loads(r[0]) for r in spark.read.text(f"{path}/manifest-[0-9]*").collect()), key=lambda x: x["version"])  # one or two
        store = cls(spark, last["buckets"], last["fanout"], path)
        store.version, store.id_type, store.levels = last["version"], last["id_type"], [list(x) for x in last["levels"]]
        spark.sql(f"CREATE TABLE {store.table} (h BINARY, n_docs BIGINT, last_doc {last['id_type']}, run STRING) USING parquet PARTITIONED BY (run) CLUSTERED BY (h) SORTED BY (h) INTO {store.buckets} BUCKETS LOCATION '{path}/runs'")
        spark.sql(f"ALTER TABLE {store.table} RECOVER PARTITIONS")
        return store

    def runs(self) -> list[str]:
        return [run for level in self.levels for run in level]

    def entries(self, runs: list[str]) -> DataFrame:
        return self.spark.table(self.table).filter(F.col("run").isin(runs)).drop("run")

    def _merged(self, runs: list[str]) -> DataFrame:
        return self.entries(runs).groupBy("h").agg(F.max("n_docs").alias("n_docs"), F.max("last_doc").alias("last_doc"))

    def state(self) -> DataFrame | None:
        """h, n_docs, last_doc of every key: the greatest of its entries."""
        return self._merged(self.runs()) if self.levels else None

    def add(self, keys: DataFrame) -> None:
        self.id_type = keys.schema["doc_id"].dataType.simpleString()
        ids = keys.groupBy("h", "doc_id").agg(F.lit(1).alias("one"))
        own = ids.groupBy("h").agg(F.count(F.lit(1)).alias("n_docs"), F.max("doc_id").alias("last_doc"))
        run = self._write(own.repartition(self.buckets, "h"))
        if self.levels:
            batch, own = run, self.entries([run])
            fresh = own.join(self.entries(self.runs()).select("h").hint("merge"), "h", "left_anti")
            known = own.join(self.state().withColumnsRenamed({"n_docs": "n_", "last_doc": "last_"}).hint("merge"), "h")
            known = known.select("h", (F.col("n_docs") + F.col("n_")).alias("n_docs"), F.greatest("last_doc", "last_").alias("last_doc"))
            run = self._write(fresh.unionByName(known))
            self._drop(batch)
        self._place(run, 0)
        for level in range(len(self.levels) + 1):
            if level < len(self.levels) and len(self.levels[level]) >= self.fanout:
                runs, self.levels[level] = self.levels[level], []
                self._place(self._write(self._merged(runs)), level + 1)
                self._manifest()
                self._drop(*runs)
        self._manifest()

    def _write(self, rows: DataFrame) -> str:
        run = uuid.uuid4().hex
        out = rows.withColumn("run", F.lit(run)).write.mode("append").format("parquet").option("path", f"{self.path}/runs").option("compression", "uncompressed")
        out.partitionBy("run").bucketBy(self.buckets, "h").sortBy("h").saveAsTable(self.table)
        return run

    def _place(self, run: str, level: int) -> None:
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(run)

    def _drop(self, *runs: str) -> None:
        for run in runs:
            self.spark.sql(f"ALTER TABLE {self.table} DROP IF EXISTS PARTITION (run = '{run}')")
            delete(self.spark, f"{self.path}/runs/run={run}")

    def _manifest(self) -> None:
        self.version += 1
        said = {"version": self.version, "buckets": self.buckets, "fanout": self.fanout, "id_type": self.id_type, "levels": self.levels}
        put(self.spark, f"{self.path}/manifest-{self.version}", json.dumps(said))
        if self.version > 1:
            delete(self.spark, f"{self.path}/manifest-{self.version - 1}")

    def repeated(self, min_docs: int) -> DataFrame:
        """h, last_doc of the keys that at least min_docs documents hold."""
        return self.state().filter(F.col("n_docs") >= min_docs)

    def close(self) -> None:
        """Removes the store: nothing lazy may still depend on it."""
        self.spark.sql(f"DROP TABLE {self.table}")
        delete(self.spark, self.path)


def _without(batches, passed: list[str], drop_column: str):
    for batch in batches:
        texts, drops = batch.column("text").to_pylist(), batch.column(drop_column).to_pylist()
        kept, lines, dropped = [], [], []
        for text, drop in zip(texts, drops):
            rows = (text or "").encode("utf-8", "surrogatepass").split(b"\n")
            lines.append(len(rows))
            if drop:
                gone = set(drop)
                rows = [x for x in rows if md5(x.strip(SPACES).lower()).digest() not in gone]
            dropped.append(lines[-1] - len(rows))
            kept.append(b"\n".join(rows).decode("utf-8", "surrogatepass"))
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(c) for c in passed), pa.array(kept, pa.string()), pa.array(lines, pa.int64()), pa.array(dropped, pa.int64())], names=[*passed, "kept_text", "n_lines", "n_dropped"]
        )


def dedup_lines(docs: DataFrame, min_chars: int = 40, min_docs: int = 5, batches: int = 4, fanout: int = 3, keys_a_bucket: int = 500_000) -> DataFrame:
    """The rows and columns of docs(doc_id, text, ...) with kept_text, n_lines and n_dropped.

    A key found in at least min_docs different doc_ids loses all its lines except in the largest doc_id that holds it,
    which keeps all of them. Null or empty text is one empty line, which is always kept. Rows that repeat a doc_id are
    one document in counts, and each gets the same decision. A null doc_id is a document, smaller than all others.
    An empty table gives an empty table. Columns named kept_text, n_lines or n_dropped are replaced, all others stay.
    The documents are dealt to `batches` by a hash of doc_id, and these are added to the runs one after the other.
    """
    spark = docs.sparkSession
    keys = materialise(line_keys(docs, min_chars).withColumn("batch", F.pmod(F.xxhash64("doc_id"), F.lit(batches))), "line-keys")
    runs = LineRuns(spark, max(8, -(-keys.count() // keys_a_bucket)), fanout)
    for b in range(batches):
        runs.add(keys.filter(F.col("batch") == b).select("doc_id", "h"))
    # a table of its own: where one line stands in very many documents, Spark can split its side of the join
    repeated = materialise(runs.repeated(min_docs).select("h", "last_doc"), "repeated-lines")
    runs.close()
    lost = keys.select("doc_id", "h").join(repeated, "h").filter(~F.col("doc_id").eqNullSafe(F.col("last_doc")))
    passed = without(docs, "kept_text", "n_lines", "n_dropped")
    of, dropped = unused(docs, "of", "dropped")
    drop = materialise(lost.groupBy(F.col("doc_id").alias(of)).agg(F.collect_set("h").alias(dropped)), "dropped-lines")
    release(keys, repeated)
    # always a merge: a broadcast would end where the keys no longer fit, and the texts' shuffle would come as a surprise there
    rows = docs.select(*passed).join(drop.hint("merge"), docs["doc_id"].eqNullSafe(drop[of]), "left").drop(of)
    schema = StructType([*(docs.schema[c] for c in passed), StructField("kept_text", StringType()), StructField("n_lines", LongType()), StructField("n_dropped", LongType())])
    return rows.mapInArrow(lambda it: _without(it, passed, dropped), schema)


__all__ = ["LineRuns", "dedup_lines", "line_keys"]
