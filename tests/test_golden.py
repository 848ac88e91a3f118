"""Golden cases stated in the survey: the 3-row engineered-feature sample and the
archived confusion matrix -> classification report."""

import math

import pandas as pd
import pytest
from pyspark.sql import functions as F

from churnlens.functions import engineered as EN
from churnlens.operators import report as RP


def test_engineered_three_rows(spark):
    rows = [(365, 45, 3, 12, 5, 49.99), (180, 20, 1, 6, 30, 39.99), (90, 8, 0, 1, 120, 29.99)]
    df = spark.createDataFrame(rows, "TenureDays int, TotalAttendanceToDate int, Visits_Last30d int, "
                                     "Visits_Last90d int, DaysSinceLastAccessed int, RegularPayment double")
    out = EN.engineer_features(df).orderBy(F.col("TenureDays").desc()).toPandas()
    # independent pandas computation of the same formulas
    p = pd.DataFrame(rows, columns=["TenureDays", "TotalAttendanceToDate", "Visits_Last30d", "Visits_Last90d",
                                    "DaysSinceLastAccessed", "RegularPayment"])
    rate = (p.TotalAttendanceToDate / (p.TenureDays + 1)).clip(0, 10)
    ratio = (p.Visits_Last30d / (p.Visits_Last90d / 3 + 0.001)).clip(0, 5)
    monthly = (p.TotalAttendanceToDate / (p.TenureDays / 30 + 0.1)).clip(0, 30)
    pay = (p.RegularPayment / (p.TotalAttendanceToDate + 1)).clip(0, 100)
    quart = pd.qcut(p.TenureDays, q=4, labels=[1, 2, 3, 4]).astype(int)
    for i in range(3):
        assert out.Engagement_Rate[i] == pytest.approx(rate[i], abs=1e-12)
        assert out.Recent_Activity_Ratio[i] == pytest.approx(ratio[i], abs=1e-12)
        assert out.Monthly_Avg_Visits[i] == pytest.approx(monthly[i], abs=1e-12)
        assert out.Payment_to_Attendance_Ratio[i] == pytest.approx(pay[i], abs=1e-12)
        assert out.Tenure_Quartile[i] == quart[i]
    assert list(out.High_Inactivity) == [0, 0, 1]
    assert list(out.Access_Gap_Months) == pytest.approx([5 / 30, 1.0, 4.0])


def test_report_from_archived_confusion_matrix(spark):
    cm = [[1527, 858, 0], [722, 1425, 0], [60, 140, 3761]]
    counts = spark.createDataFrame([(y, p, cm[y][p]) for y in range(3) for p in range(3)], "y int, pred int, n long")
    rep = {r["label"]: r for r in RP.classification_report(None, counts=counts).collect()}
    assert rep["0"]["precision"] == pytest.approx(0.6613, abs=5e-5)
    assert rep["0"]["recall"] == pytest.approx(0.6403, abs=5e-5)
    assert rep["0"]["f1"] == pytest.approx(0.6506, abs=5e-5)
    assert rep["1"]["precision"] == pytest.approx(0.5881, abs=5e-5)
    assert rep["1"]["recall"] == pytest.approx(0.6637, abs=5e-5)
    assert rep["2"]["precision"] == pytest.approx(1.0)
    assert rep["2"]["recall"] == pytest.approx(0.9495, abs=5e-5)
    assert rep["2"]["support"] == 3961
    assert rep["macro avg"]["f1"] == pytest.approx(0.7495, abs=5e-5)
    assert rep["weighted avg"]["precision"] == pytest.approx(0.8008, abs=5e-5)
    assert rep["weighted avg"]["f1"] == pytest.approx(0.7947, abs=5e-5)
    assert rep["accuracy"]["f1"] == pytest.approx(6713 / 8493)
    assert not math.isnan(rep["macro avg"]["precision"])
