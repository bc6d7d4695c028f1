"""Small test inputs in the layouts of FIXTURES.md, generated by our own code."""

from __future__ import annotations

import datetime as dt

import numpy as np
import pandas as pd

ITEMS = [f"FOODS_1_00{i}" for i in range(1, 6)]
STORES = ["CA_1", "TX_1"]


def calendar_pdf(n_days: int = 120, seed: int = 42) -> pd.DataFrame:
    rng = np.random.default_rng(seed)
    dates = [dt.date(2016, 1, 1) + dt.timedelta(days=i) for i in range(n_days)]
    ev_days = set(rng.choice(n_days, size=5, replace=False).tolist())
    return pd.DataFrame({
        "date": [d.isoformat() for d in dates],
        "wm_yr_wk": [11101 + i // 7 for i in range(n_days)],
        "weekday": [d.strftime("%A") for d in dates],
        "wday": [d.isoweekday() for d in dates],
        "month": [d.month for d in dates],
        "year": [d.year for d in dates],
        "d": [f"d_{i + 1}" for i in range(n_days)],
        "event_name_1": ["SuperBowl" if i in ev_days else None for i in range(n_days)],
        "event_type_1": ["Sporting" if i in ev_days else None for i in range(n_days)],
        "event_name_2": [None] * n_days,
        "event_type_2": [None] * n_days,
        "snap_CA": rng.integers(0, 2, n_days), "snap_TX": rng.integers(0, 2, n_days),
        "snap_WI": rng.integers(0, 2, n_days),
    })


def sales_wide_pdf(n_days: int = 120, seed: int = 42) -> pd.DataFrame:
    rng = np.random.default_rng(seed)
    rows = []
    for it in ITEMS:
        for st in STORES:
            row = {"id": f"{it}_{st}_validation", "item_id": it, "dept_id": "FOODS_1", "cat_id": "FOODS",
                   "store_id": st, "state_id": st.split("_")[0]}
            row.update({f"d_{i + 1}": int(v) for i, v in enumerate(rng.poisson(5, n_days))})
            rows.append(row)
    return pd.DataFrame(rows)


def prices_pdf(n_days: int = 120, seed: int = 42) -> pd.DataFrame:
    rng = np.random.default_rng(seed)
    weeks = sorted({11101 + i // 7 for i in range(n_days)})
    rows = []
    for it in ITEMS:
        for st in STORES:
            base = rng.uniform(1, 10)
            for w in weeks:
                rows.append({"store_id": st, "item_id": it, "wm_yr_wk": w,
                             "sell_price": round(base + rng.uniform(-0.5, 0.5), 2)})
    return pd.DataFrame(rows)


def write_csvs(folder: str, n_days: int = 120) -> None:
    calendar_pdf(n_days).to_csv(f"{folder}/calendar.csv", index=False)
    sales_wide_pdf(n_days).to_csv(f"{folder}/sales_train_validation.csv", index=False)
    prices_pdf(n_days).to_csv(f"{folder}/sell_prices.csv", index=False)


def causal_pdf(n: int = 3000, seed: int = 42) -> pd.DataFrame:
    """Known-truth price effect: tau = -1 - [electronics] + base_volatility."""
    rng = np.random.default_rng(seed)
    hol = rng.binomial(1, 0.1, n)
    dow = rng.integers(0, 7, n)
    cat = rng.choice(["electronics", "clothing", "food"], n)
    vol = rng.uniform(0.1, 0.5, n)
    elec = (cat == "electronics").astype(float)
    price = 10 + 5 * hol + 20 * elec + rng.normal(0, 2, n)
    tau = -1 - elec + vol
    sales = 100 + 50 * hol + tau * price + rng.normal(0, 5, n)
    return pd.DataFrame({"row_id": np.arange(n).astype(str), "is_holiday": hol, "day_of_week": dow,
                         "category": cat, "base_volatility": vol, "price": price, "true_tau": tau,
                         "sales": sales})
