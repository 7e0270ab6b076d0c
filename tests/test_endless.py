"""The endless scan: a stream stopped and restarted, and cycles of a batch."""

import pytest
from almanac.sources import endless
from pyspark.sql import functions as F


@pytest.fixture(scope="module")
def files(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("endless")
    for k, n in enumerate((30, 0, 7, 55)):
        spark.range(100 * k, 100 * k + n).select("id", F.concat(F.lit("text "), F.col("id").cast("string")).alias("text")).coalesce(1).sortWithinPartitions("id").write.option("parquet.block.size", "512").parquet(str(folder / f"dump-{k}"))
    endless.register(spark)
    return str(folder)


WANT = [100 * k + i for k, n in enumerate((30, 0, 7, 55)) for i in range(n)]


def test_stream_stopped_and_restarted_gives_the_endless_scan(spark, files, tmp_path):
    def run():
        s = spark.readStream.format("endless_corpus").options(path=files, columns="id", rows_per_batch=41, rows_per_task=9, progress=str(tmp_path / "progress")).load()
        q = s.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start()
        q.awaitTermination()

    for _ in range(6):
        run()
    got = sorted((r.place, r.id, r.cycle) for r in spark.read.parquet(str(tmp_path / "out")).collect())
    assert got == [(p, WANT[p % 92], p // 92) for p in range(6 * 41)]
    # a batch that was logged but not finished is read again, not skipped and not doubled
    commits = sorted((tmp_path / "state" / "commits").glob("[0-9]*"), key=lambda f: int(f.name))
    commits[-1].unlink()
    (tmp_path / "state" / "commits" / f".{commits[-1].name}.crc").unlink(missing_ok=True)
    for batches in (6, 7):
        run()
        assert sorted(r.place for r in spark.read.parquet(str(tmp_path / "out")).collect()) == list(range(batches * 41))


def test_batch_of_cycles_with_pruned_ranges(spark, files):
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    df = spark.read.format("endless_corpus").options(path=files, rows_per_task=10, cycles=3).load()
    assert [r.id for r in df.orderBy("place").collect()] == WANT * 3 and df.where("text IS NULL").isEmpty()
    some = df.where("cycle = 1 AND place < 110")
    assert [r.place for r in some.orderBy("place").collect()] == list(range(92, 110)) and some.rdd.getNumPartitions() < 6
    assert df.where("part IN (2, 9)").select("cycle").distinct().count() == 3 and df.where("cycle >= 2 AND cycle > 2").count() == 0
    spark.conf.unset("spark.sql.python.filterPushdown.enabled")


def test_what_cant_be_scanned_is_an_error(spark, files, tmp_path):
    for options in ({"path": str(tmp_path)}, {"path": files, "rows_per_task": 0}):
        with pytest.raises(Exception, match="no Parquet files|rows_per_task"):
            spark.read.format("endless_corpus").options(**options).load().count()
