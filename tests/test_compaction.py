import pytest
from pyspark.sql import functions as F

from tidemark.operators import compaction, files
from tidemark.operators.catalog import table_detail
from tidemark.operators.compaction import compact_log
from tidemark.operators.runlog import append_log


def rows(spark, start, end, parts=1):
    return spark.range(start, end, 1, parts).select("id", F.lit("run").alias("alias"))


def location(spark, table):
    return files.same_place(spark, table_detail(spark, table)["location"])


def content(spark, table):
    return sorted(r.id for r in spark.table(table).collect())


@pytest.fixture
def log(spark, database):
    table = f"{database}.runs"
    append_log(rows(spark, 0, 2880, 180), table)
    return table


def generations(spark, log):
    return files.folders(spark, spark.catalog.getDatabase(log.split(".")[0]).locationUri, "runs__g_")


def test_many_rows_end_in_one_file(spark, log):
    assert compact_log(spark, log) == 180
    assert len(spark.table(log).inputFiles()) == 1 and content(spark, log) == list(range(2880))
    assert compact_log(spark, log) == 0  # few files are left alone
    append_log(rows(spark, 2880, 2890), log)
    assert content(spark, log) == list(range(2890))


def test_rows_appended_between_read_and_swap_are_kept(spark, log, monkeypatch):
    """One is appended while the copy is made, one just before the swap, both from another session."""
    other, swap, size = spark.newSession(), compaction._point, compaction._bytes

    def before_copy(*given):
        append_log(rows(other, 5000, 5001), log)
        return size(*given)

    def before_swap(*given):
        append_log(rows(other, 6000, 6001), log)
        swap(*given)

    monkeypatch.setattr(compaction, "_bytes", before_copy)
    monkeypatch.setattr(compaction, "_point", before_swap)
    compact_log(spark, log)
    assert content(spark, log) == [*range(2880), 5000, 6000]
    append_log(rows(other, 7000, 7001), log)  # the other session still knows the former folder
    spark.catalog.refreshTable(log)  # this one lists anew what the other added
    assert content(spark, log) == [*range(2880), 5000, 6000, 7000]
    assert 7000 in content(other, log)


def test_a_late_writer_of_the_former_generation_is_moved_by_the_next_compaction(spark, log):
    former = location(spark, log)
    compact_log(spark, log)
    rows(spark, 9000, 9002).write.mode("append").parquet(former)  # its job began before the swap
    append_log(rows(spark, 3000, 3040, 40), log)
    compact_log(spark, log)
    assert content(spark, log) == [*range(2880), *range(3000, 3040), 9000, 9001]
    assert not files.exists(spark, former) and len(generations(spark, log)) == 2
    compact_log(spark, log, least_files=2)
    assert content(spark, log) == [*range(2880), *range(3000, 3040), 9000, 9001]


def test_a_driver_lost_before_the_swap_leaves_the_log_as_it_was(spark, log, monkeypatch):
    with monkeypatch.context() as patch:
        patch.setattr(compaction, "_point", lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            compact_log(spark, log)
    assert content(spark, log) == list(range(2880)) and len(generations(spark, log)) == 1
    assert compact_log(spark, log) == 180
    assert content(spark, log) == list(range(2880)) and len(generations(spark, log)) == 1


def test_a_driver_lost_after_the_swap_leaves_nothing_out(spark, log, monkeypatch):
    swap = compaction._point
    with monkeypatch.context() as patch:
        def lost(*given):
            append_log(rows(spark, 6000, 6001), log)
            swap(*given)
            raise RuntimeError("lost")

        patch.setattr(compaction, "_point", lost)
        with pytest.raises(RuntimeError):
            compact_log(spark, log)
    assert compact_log(spark, log) == 0  # moves the row over, and finds too few files to merge
    spark.catalog.refreshTable(log)
    assert content(spark, log) == [*range(2880), 6000]


def test_a_large_log_ends_in_files_of_the_size_asked_for(spark, log):
    compact_log(spark, log, file_bytes=4096)
    assert 1 < len(spark.table(log).inputFiles()) < 180 and content(spark, log) == list(range(2880))


def test_an_empty_and_a_partitioned_log(spark, database):
    append_log(rows(spark, 0, 0), f"{database}.none")
    assert compact_log(spark, f"{database}.none") == 0 and spark.table(f"{database}.none").isEmpty()
    rows(spark, 0, 3).write.partitionBy("alias").saveAsTable(f"{database}.parts")
    with pytest.raises(ValueError, match="partitioned"):
        compact_log(spark, f"{database}.parts")
