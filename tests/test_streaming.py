from __future__ import annotations

from convoy.sources.anomaly_store import read_anomalies
from convoy.streaming.arrivals import detect_arrivals
from tests.test_jobs import DAY_1, DAY_2, FAULTY, SOUND, land


def test_each_finished_day_is_checked_once(spark, root):
    land(spark, root, DAY_1, *FAULTY)
    land(spark, root, DAY_2, *SOUND)
    found = [(s["detect_date"], s["total"]) for s in detect_arrivals(spark, root)]
    assert found == [(DAY_1, 2), (DAY_2, 0)]
    assert detect_arrivals(spark, root) == []
    land(spark, root, DAY_2, *FAULTY)
    assert [s["detect_date"] for s in detect_arrivals(spark, root)] == [DAY_2]
    assert read_anomalies(spark, root).count() == 4
