from __future__ import annotations

import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from shelftide.session import local_session

    session = local_session(8)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SMALL


@pytest.fixture(scope="session")
def random_series(spark):
    """Three series of different length with nulls, and one single-row series."""
    import numpy as np
    import pandas as pd

    rng = np.random.default_rng(7)
    parts = []
    for store, product, n in ((1, 1, 400), (1, 2, 57), (2, 1, 190), (3, 9, 1)):
        y = np.round(rng.gamma(1.5, 10, n), 4)
        y[rng.random(n) < 0.15] = 0.0
        s = pd.Series(y)
        if n > 1:
            s[rng.random(n) < 0.05] = None
        # Hours with gaps.
        hours = np.cumsum(rng.integers(1, 4, n))
        parts.append(pd.DataFrame({
            "store_id": store, "product_id": product, "first_category_id": product % 2,
            "dt": pd.Timestamp("2024-01-01") + pd.to_timedelta(hours, unit="h"),
            "sale_amount": s, "holiday_flag": rng.integers(0, 2, n),
        }))
    pdf = pd.concat(parts, ignore_index=True)
    schema = ("store_id long, product_id long, first_category_id long, dt timestamp, "
              "sale_amount double, holiday_flag int")
    rows = [
        (int(r.store_id), int(r.product_id), int(r.first_category_id), r.dt.to_pydatetime(),
         None if pd.isna(r.sale_amount) else float(r.sale_amount), int(r.holiday_flag))
        for r in pdf.itertuples()
    ]
    return pdf, spark.createDataFrame(rows, schema).repartition(4).cache()
