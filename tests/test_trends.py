import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from earshot.operators import trends

DAY = dt.date(2025, 1, 1)
SCHEMA = "feedback_date date, theme string, theme_count long, total_feedback long, theme_share double"


def series(theme, shares, start=DAY, skip=()):
    return [
        (start + dt.timedelta(days=i), theme, round(s * 1000), 1000, float(s))
        for i, s in enumerate(shares) if i not in skip
    ]


@pytest.fixture(scope="module")
def daily(spark):
    wave = [0.02 + 0.002 * (i % 3) for i in range(60)]
    rows = series("flat", wave)
    rows += series("spike", wave[:53] + [0.2] * 7)
    rows += series("constant", [0.05] * 60)
    rows += series("gaps", wave, skip=(10, 11, 12, 40))
    rows += series("ended", wave[:23] + [0.3] * 7)
    rows += series("short", wave[:5])
    return spark.createDataFrame(rows, SCHEMA)


def expected(pdf):
    s = pdf.set_index(pd.to_datetime(pdf.feedback_date)).theme_share.asfreq("D", fill_value=0)
    base = s.shift(7).rolling(30, min_periods=14)
    recent, mean, std = s.rolling(7).mean(), base.mean(), base.std()
    return pd.DataFrame({
        "recent_avg": recent, "baseline_mean": mean, "baseline_std": std,
        "z_score": (recent - mean) / std.mask(std < 1e-12), "change": (recent - mean) / mean.replace(0, np.nan),
    })


def test_metrics_equal_pandas(daily):
    got = trends.emerging_daily(daily).where("theme <> 'constant'").toPandas().sort_values("feedback_date")
    for theme, pdf in daily.where("theme <> 'constant'").toPandas().sort_values("feedback_date").groupby("theme"):
        want, mine = expected(pdf), got[got.theme == theme]
        assert len(mine) == len(want)
        for column in want:
            np.testing.assert_allclose(
                mine[column].to_numpy(dtype=float), want[column].to_numpy(), rtol=1e-6, atol=1e-9, err_msg=f"{theme} {column}"
            )


def test_gaps_are_filled_with_zero(daily):
    rows = trends.emerging_daily(daily).where("theme = 'gaps'")
    assert rows.count() == 60
    assert rows.where("theme_share = 0").count() == 4


def test_zero_deviation_gives_null_not_an_error(daily):
    rows = trends.emerging_daily(daily).where("theme = 'constant'")
    assert rows.where("baseline_std = 0 and z_score is not null").count() == 0


def test_planted_spike_raises_alerts_as_of_each_theme_or_the_table(daily):
    metrics = trends.emerging_daily(daily)
    labels = {"spike": "Spike"}
    own = trends.alerts(metrics, labels).collect()
    assert {r.theme for r in own} == {"Spike", "ended"}
    table = trends.alerts(metrics, labels, as_of="table_max").collect()
    assert [r.theme for r in table] == ["Spike"]
    alert = table[0]
    assert alert.severity == "Critical" and alert.recent_7d_share_pct == 20.0
    assert alert.message.startswith("\U0001F6A8 Emerging Issue Detected: Spike complaints rose from a baseline of ")
    assert "to 20.00% of feedback over the last 7 days (+" in alert.message
    with pytest.raises(ValueError):
        trends.latest_per_theme(metrics, "yesterday")


def test_min_recent_count_drops_sparse_themes(daily):
    metrics = trends.emerging_daily(daily)
    rule = trends.AlertRule(min_recent_count=1401)
    assert {r.theme for r in trends.alerts(metrics, {}, rule).collect()} == {"ended"}


def test_share_counts_messages_once_and_themes_each(spark):
    kind = "id int, day date, inferred_themes array<string>"
    other = DAY + dt.timedelta(days=1)
    rows = [
        (1, DAY, ["a", "b"]), (2, DAY, ["a"]), (3, DAY, ["unclassified"]), (4, DAY, ["b", "a"]),
        (5, DAY, None), (6, other, ["a"]), (7, other, [None]),
    ]
    got = trends.theme_daily_share(spark.createDataFrame(rows, kind), F.col("day")).collect()
    found = {(r.feedback_date, r.theme): (r.theme_count, r.total_feedback, r.theme_share) for r in got}
    assert found == {
        (DAY, "a"): (3, 5, 0.6), (DAY, "b"): (2, 5, 0.4), (DAY, "unclassified"): (1, 5, 0.2), (other, "a"): (1, 2, 0.5),
    }


def test_rate_split_puts_the_cutoff_day_before(spark):
    rows = [(DAY, ["x"]), (DAY + dt.timedelta(days=1), ["x", "y"]), (DAY + dt.timedelta(days=2), ["y"])]
    df = spark.createDataFrame(rows, "day date, inferred_themes array<string>")
    row = trends.rate_split(df, "x", F.col("day"), F.lit(DAY + dt.timedelta(days=1))).first()
    assert (row.n_before, row.hits_before, row.n_after, row.hits_after) == (2, 2, 1, 0)
    assert (row.rate_before, row.rate_after) == (1.0, 0.0)
