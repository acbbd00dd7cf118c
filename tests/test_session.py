import pytest

from labelloom import session


@pytest.mark.parametrize("keep", [session.checkpointed, lambda df: session.written(df, "kept")])
def test_finished_jobs_are_let_go(spark, monkeypatch, keep):
    # a heap over its share is collected, another is left alone; what is written stays
    beans = spark.sparkContext._jvm.java.lang.management.ManagementFactory.getGarbageCollectorMXBeans()
    full = lambda: sum(b.getCollectionCount() for b in beans if "Young" not in b.getName())
    for share, least in ((0.0, 1), (1.0, 0)):
        monkeypatch.setattr(session, "HEAP_SHARE", share, raising=False)
        before = full()
        kept = keep(spark.range(100))
        assert full() - before >= least and (least or full() == before)
        assert kept.count() == 100
