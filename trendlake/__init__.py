"""trendlake: trend analytics on Spark.

The main entry points, all DataFrame -> DataFrame:

* ``mention_job`` - parsed log payloads -> (mentions, dates)
* ``dense_daily_counts`` / ``dense_counts_from_cells`` - the entity x date grid
* ``lag_features``, ``scoring_rows``, ``forecast`` - features and next-day forecasts
* ``apply_feed_rules`` - the post collector's feed rules
* ``page_posts``, ``page_edges`` - records from stored pages
* ``DailyJob`` / ``run_batch`` - whole scheduled runs
"""

from .operators.features import lag_features, scoring_rows  # noqa: F401
from .operators.feeds import apply_feed_rules  # noqa: F401
from .operators.forecast import forecast  # noqa: F401
from .operators.grid import dense_counts_from_cells, dense_daily_counts, merge_cells  # noqa: F401
from .operators.mentions import mention_job  # noqa: F401
from .operators.pages import page_edges, page_posts  # noqa: F401
from .plans.batch_job import run_batch  # noqa: F401
from .plans.daily_job import DailyJob  # noqa: F401
