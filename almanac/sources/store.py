"""Stored result tables with keys: hash buckets of Parquet files under a log of numbered commits.

A row's bucket follows from its key. A write reads and writes only the buckets of its keys, into
a folder of its own, and is there once its commit is: a small file that names each bucket's folder, put in place under the
next number by a rename that fails where that number is taken. A writer that comes second
finds so and does its change again on what the first one left, so neither loses anything. Readers see one
commit. Commits before the last ``KEPT`` go, with the folders that only they name. Keys are held by every write.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import file_system

#: The result tables: columns, key, and the column that says which of two rows with one key came last.
TABLES = {
    "evaluations": ("uid long, year int, repo_id string, round int, passed boolean, score double, score_unknown double, score_known double, synced boolean, evaluated_at timestamp", ["uid", "year", "round"], "evaluated_at"),
    "eval_runs": ("week long, completed_at timestamp", ["week"], "completed_at"),
    "svd_spectra": ("uid long, round int, layer long, spectrum array<double>", ["uid", "round", "layer"]),
    "quality_prompts": ("round int, prompts_json string", ["round"]),
    "quality_completions": ("round int, year int, uid long, completions_json string", ["round", "year", "uid"]),
}
#: Buckets of a new table, commits that are kept, and times that a write is done again after others came first.
BUCKETS, KEPT, TRIES = 16, 10, 20


class Conflict(RuntimeError):
    """Other writers came first again and again."""


@dataclass
class ResultStore:
    """Tables under one folder of a store that all executors share; ``tables`` names each one's columns, key and, if it has one, version column."""

    spark: SparkSession
    folder: str
    tables: dict[str, tuple]
    buckets: int = BUCKETS

    def _commits(self, name: str) -> list[int]:
        fs, path = file_system(self.spark, f"{self.folder}/{name}/log")
        if not fs.exists(path):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(path)]
        return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and not n.startswith("."))

    def _manifest(self, name: str, commit: int) -> dict:
        """``buckets``: how many, ``at``: each filled bucket's folder."""
        fs, path = file_system(self.spark, f"{self.folder}/{name}/log/{commit:012d}.json")
        stream = fs.open(path)
        try:
            return json.loads(bytes(stream.readAllBytes()).decode())
        finally:
            stream.close()

    def _latest(self, name: str) -> tuple[int, dict]:
        have = self._commits(name)
        if not have:
            raise FileNotFoundError(f"{self.folder}/{name}: no such table")
        return have[-1], self._manifest(name, have[-1])

    def _commit(self, name: str, number: int, manifest: dict) -> bool:
        """Whether this writer put the commit of that number in place."""
        fs, side = file_system(self.spark, f"{self.folder}/{name}/log/.{uuid.uuid4().hex}")
        _, target = file_system(self.spark, f"{self.folder}/{name}/log/{number:012d}.json")
        jvm = self.spark.sparkContext._jvm
        stream = fs.create(side, False)
        stream.write(json.dumps(manifest).encode())
        stream.close()
        try:
            # FileContext's rename fails where the target exists; FileSystem's may replace it
            context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), self.spark.sparkContext._jsc.hadoopConfiguration())
            none = self.spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
            context.rename(fs.makeQualified(side), fs.makeQualified(target), none)
            return True
        except Exception as e:
            if "FileAlreadyExistsException" in str(e) or fs.exists(target):
                fs.delete(side, False)
                return False
            raise

    def _drop_old(self, name: str) -> None:
        """Without commits before the last ``KEPT`` and the folders that no other names. A write that isn't committed yet names none of them."""
        have = self._commits(name)
        old, kept = have[:-KEPT], have[-KEPT:]
        if not old:
            return
        used = {p for k in kept for p in self._manifest(name, k)["at"].values()}
        gone = {p for k in old for p in self._manifest(name, k)["at"].values()} - used
        for p in [*(f"{self.folder}/{name}/{g}" for g in gone), *(f"{self.folder}/{name}/log/{k:012d}.json" for k in old)]:
            fs, path = file_system(self.spark, p)
            fs.delete(path, True)

    def _rows(self, name: str, manifest: dict, buckets: list[int] | None = None) -> DataFrame:
        paths = [f"{self.folder}/{name}/{p}" for b, p in manifest["at"].items() if buckets is None or int(b) in buckets]
        columns = self.tables[name][0]
        return self.spark.read.schema(columns).parquet(*paths) if paths else self.spark.createDataFrame([], columns)

    def _bucket(self, name: str, n: int):
        return F.pmod(F.xxhash64(*self.tables[name][1]), F.lit(n)).cast("int")

    def _change(self, name: str, touched: Callable[[dict], list[int] | None], change: Callable[[DataFrame], DataFrame]) -> list[int]:
        """Replace the rows of the touched buckets by ``change`` of them; the buckets that were written."""
        for _ in range(TRIES):
            number, manifest = self._latest(name)
            mine = touched(manifest)
            mine = sorted(int(b) for b in manifest["at"]) if mine is None else mine
            if not mine:
                return []
            own = f"data/{uuid.uuid4().hex}"
            after = change(self._rows(name, manifest, mine)).withColumn("_bucket", self._bucket(name, manifest["buckets"]))
            after.repartition(len(mine), "_bucket").write.partitionBy("_bucket").parquet(f"{self.folder}/{name}/{own}")
            fs, path = file_system(self.spark, f"{self.folder}/{name}/{own}")
            filled = [s.getPath().getName() for s in fs.listStatus(path) if s.isDirectory()]
            at = {b: p for b, p in manifest["at"].items() if int(b) not in mine} | {n.removeprefix("_bucket="): f"{own}/{n}" for n in filled}
            if self._commit(name, number + 1, {"buckets": manifest["buckets"], "at": at}):
                self._drop_old(name)
                return mine
            fs.delete(path, True)
        raise Conflict(f"{name}: {TRIES} times another writer came first")

    def create(self) -> None:
        """Every table that isn't there yet, empty."""
        for name in self.tables:
            if not self._commits(name):
                self._commit(name, 0, {"buckets": self.buckets, "at": {}})

    def read(self, name: str) -> DataFrame:
        return self._rows(name, self._latest(name)[1])

    def _fitted(self, name: str, rows: DataFrame) -> DataFrame:
        """``rows`` with the table's columns (NULL where they have none), keys never NULL, one row a key: that of the
        greatest version, or without a version column, or of equal versions, the greatest by its columns in order."""
        columns, keys, *version = self.tables[name]
        schema = self.spark.createDataFrame([], columns).schema
        full = rows.select(*(F.col(f.name).cast(f.dataType).alias(f.name) if f.name in rows.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in schema))
        for k in keys:
            full = full.withColumn(k, F.coalesce(k, F.raise_error(F.lit(f"{name}.{k} is NULL")).cast(schema[k].dataType)))
        held = [f.name for f in schema if f.name not in keys]
        best = F.max(F.struct(*(F.col(v).alias("_version") for v in version), *held))
        return full.groupBy(*keys).agg(best.alias("_r")).select(*keys, *(f"_r.{c}" for c in held)).select(*schema.names)

    def _buckets_of(self, name: str, rows: DataFrame) -> Callable[[dict], list[int]]:
        return lambda manifest: sorted(r[0] for r in rows.select(self._bucket(name, manifest["buckets"])).distinct().collect())

    def upsert(self, name: str, rows: DataFrame) -> list[int]:
        """Insert or replace by key; the last of rows with one key is taken. Returns the buckets that were written."""
        new, keys = self._fitted(name, rows), self.tables[name][1]
        return self._change(name, self._buckets_of(name, new), lambda old: old.join(new.select(*keys), keys, "left_anti").unionByName(new))

    def insert_ignore(self, name: str, rows: DataFrame) -> list[int]:
        """Insert rows whose keys the table doesn't have."""
        new, keys = self._fitted(name, rows), self.tables[name][1]
        return self._change(name, self._buckets_of(name, new), lambda old: old.unionByName(new.join(old.select(*keys), keys, "left_anti")))

    def delete(self, name: str, condition: str) -> list[int]:
        """Without the rows that meet a condition; buckets that hold none of them stay as they are."""
        hit = lambda m: sorted(r[0] for r in self._rows(name, m).where(condition).select(self._bucket(name, m["buckets"])).distinct().collect())
        return self._change(name, hit, lambda old: old.where(f"NOT coalesce({condition}, false)"))

    def has(self, name: str, **key) -> bool:
        """Whether a row has these values."""
        rows = self.read(name)
        for c, v in key.items():
            rows = rows.where(F.col(c) == v)
        return not rows.isEmpty()


def result_store(spark: SparkSession, folder: str) -> ResultStore:
    """The result tables in a folder, made where they are missing."""
    store = ResultStore(spark, folder, TABLES)
    store.create()
    return store


def save_spectra(store: ResultStore, spectra: DataFrame, round_: int) -> None:
    """Insert or replace the spectra (uid, layer, spectrum) of a round."""
    store.upsert("svd_spectra", spectra.withColumn("round", F.lit(round_)))


def spectra_of(store: ResultStore, round_: int) -> DataFrame:
    """(uid, layer, spectrum) of a round."""
    return store.read("svd_spectra").where(F.col("round") == round_).select("uid", "layer", "spectrum")
