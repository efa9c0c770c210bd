from perennial.plans.replay_job import in_year_order


def test_every_year_has_tasks_of_its_own_and_nothing_is_sampled(spark):
    rows = [(f"k{i}", "m", year) for year, n in ((2001, 90), (1999, 250), (None, 10), (2000, 1)) for i in range(n)]
    sent = in_year_order(spark.createDataFrame(rows, "key string, value string, year int"), 100)
    assert "rangepartitioning" not in sent._jdf.queryExecution().toString().lower()
    parts = [[r.year for r in part] for part in sent.rdd.glom().collect()]
    assert len(parts) == 6 and sum(map(len, parts)) == 351
    assert [set(part) for part in parts if part] == [{None}, {1999}, {1999}, {1999}, {2000}, {2001}]
    assert in_year_order(sent.limit(0), 100).collect() == []
