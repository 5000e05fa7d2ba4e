import datetime as dt

from trendlake.operators import grid
from trendlake.operators.features import lag_features
from trendlake.session import shared_path
from trendlake.sinks.bucketed import open_bucketed, read_bucketed, write_bucketed

ROWS = [(f"e{i % 40}", "ORG" if i % 3 else "X", dt.date(2025, 8, 1) + dt.timedelta(days=i % 9)) for i in range(2000)]
SCHEMA = "entity_text string, entity_type string, published_date date"


def test_cells_grid_and_lags_need_no_exchange_of_mentions(spark):
    path = shared_path(spark, "t-bucketed")
    rows = spark.createDataFrame([*ROWS, (None, "ORG", None)], SCHEMA)
    for batch in range(2):
        write_bucketed(rows.where(f"coalesce(day(published_date), 0) % 2 = {batch}"), "t_fact", path, batch, "it's", 4)
    write_bucketed(rows.where("day(published_date) % 2 = 1"), "t_fact", path, 1, "it's", 4)     # replaces itself
    fact = read_bucketed(spark, "t_fact", path, 4)
    assert fact.exceptAll(rows).count() == 0 and fact.count() == rows.count()
    cells = grid.entity_date_cells(fact, ("ORG",))
    dense = grid.dense_counts_from_cells(cells, None, "2025-08-01", "2025-08-09", calendar="dense")
    lags = lag_features(dense, encode=False)
    for df in (cells, dense, lags):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "Bucketed: true" in plan
    plain = grid.dense_daily_counts(rows, None, "2025-08-01", "2025-08-09", ("ORG",), calendar="dense")
    assert dense.count() == plain.count() and dense.exceptAll(plain).count() == 0


def test_another_session_opens_the_same_files(spark):
    path = shared_path(spark, "t-reopened")
    write_bucketed(spark.createDataFrame(ROWS, SCHEMA), "t_first", path, 0, buckets=4)
    other = spark.newSession()
    assert open_bucketed(other, "t_second", path, 4).count() == len(ROWS)
