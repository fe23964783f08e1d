"""Scopes of temporary tables."""

from concurrent.futures import ThreadPoolExecutor
from threading import Barrier

from tracewright.llm.common import kept, temporary, written


def test_tables_of_two_threads_do_not_mix(spark):
    ready = Barrier(2)

    def run(n):
        with temporary():
            ready.wait()
            lost = written(spark.range(n), "lost")
            ready.wait()
            stays = kept(written(lost.withColumnRenamed("id", "x"), "stays"))
            if n == 10:
                ready.wait()  # the other block has ended by then
        if n != 10:
            ready.wait()
        return stays, lost

    with ThreadPoolExecutor(2) as pool:
        found = list(pool.map(run, (10, 20)))
    for (stays, lost), n in zip(found, (10, 20), strict=True):
        assert stays.count() == n
        path = spark._jvm.org.apache.hadoop.fs.Path(lost.written_to)
        assert not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)


def test_inner_tables_that_are_kept_end_with_the_outer_block(spark):
    exists = lambda df: spark._jvm.org.apache.hadoop.fs.Path(df.written_to).getFileSystem(spark._jsc.hadoopConfiguration()).exists(spark._jvm.org.apache.hadoop.fs.Path(df.written_to))
    with temporary():
        with temporary():
            inner = kept(written(spark.range(3), "inner"))
        assert exists(inner)
        whole = kept(written(inner, "whole"))
    assert not exists(inner) and exists(whole)
