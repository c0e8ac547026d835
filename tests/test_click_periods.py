import datetime
import random

import pytest

from tallyloom.plans import ad_clicks as ad_plan

START = datetime.datetime(2024, 3, 1)
CLICK = "ts timestamp, province string, city string, user_id bigint, ad_id bigint"


def merged(times, idle):
    periods = []
    for t in sorted(times):
        if periods and t <= periods[-1][1] + idle:
            periods[-1] = (periods[-1][0], t, periods[-1][2] + 1)
        else:
            periods.append((t, t, 1))
    return periods


@pytest.mark.parametrize("rows", [7, 10_000])
def test_periods_of_many_keys_equal_a_loop(spark, tmp_path, rows):
    """Keys with nulls and large numbers; batches overlap in time; far fewer rows of state than keys."""
    rng, root = random.Random(3), str(tmp_path / "root")
    places = [(f'p"{i % 9}', None if i % 7 == 0 else f"c:{i}", None if i % 11 == 0 else 2**60 + i) for i in range(400)]
    clicks, idle = {}, 60
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", rows)
    try:
        for batch in range(3):
            new = [(p, batch * 300 + rng.randrange(600)) for p in places for _ in range(2)]
            for p, t in new:
                clicks.setdefault(p, []).append(t)
            given = [(START + datetime.timedelta(seconds=t), *p[:2], 1, p[2]) for p, t in new]
            spark.createDataFrame(given, CLICK).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
            stream = spark.readStream.schema(CLICK).parquet(str(tmp_path / "in"))
            query = ad_plan.start_click_periods(stream, root, str(tmp_path / "cp"), f"{idle} seconds", lateness="1 hour")
            query.awaitTermination()
            assert max(x["numRowsTotal"] for p in query.recentProgress for x in p["stateOperators"]) <= 3 * 64
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    found = {}
    for r in ad_plan.click_periods(spark, root).collect():
        first, end = ((t - START).total_seconds() for t in (r.period_start, r.period_end))
        found.setdefault((r.province, r.city, r.ad_id), []).append((first, end - idle, r.click_count))
    assert {k: sorted(v) for k, v in found.items()} == {k: merged(v, idle) for k, v in clicks.items()}
