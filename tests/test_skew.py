"""Hot keys: one member holds a third of all orders; results must equal a
brute-force computation (no rows dropped or capped)."""

import datetime as dt
import random

import pandas as pd
from pyspark.sql import functions as F

from martcraft.plans import commerce


def _orders(spark, n=3000):
    rnd = random.Random(7)
    rows = []
    for i in range(n):
        member = "hot" if i % 3 == 0 else (f"m{rnd.randint(0, 300)}" if i % 11 else None)
        day = dt.date(2024, 1, 1) + dt.timedelta(days=rnd.randint(0, 59))
        rows.append((day, "brand_a" if i % 2 else "brand_b", f"o{i}", member,
                     dt.datetime.combine(day, dt.time(rnd.randint(0, 23)))))
    return spark.createDataFrame(rows, "report_date date, mall string, order_id string, member_id string, "
                                       "ordered_at timestamp")


def test_repurchase_with_hot_member_matches_brute_force(spark):
    o = _orders(spark)
    got = {(r.report_date, r.mall): (r.member_orders, r.first_purchase, r.first_repurchase, r.repurchase_orders)
           for r in commerce.repurchase_daily(o).collect()}
    pdf = o.toPandas()
    pdf = pdf[pdf.member_id.notna() & (pdf.member_id != "")].sort_values(["ordered_at", "order_id"])
    pdf["seq"] = pdf.groupby(["mall", "member_id"]).cumcount() + 1
    exp = {}
    for (d, m), g in pdf.groupby(["report_date", "mall"]):
        exp[(d, m)] = (len(g), int((g.seq == 1).sum()), int((g.seq == 2).sum()), int((g.seq >= 2).sum()))
    assert got == exp
    hot = pdf[pdf.member_id == "hot"]
    assert len(hot) >= len(pdf) / 3                     # the skew really is there


def test_crm_top3_for_hot_member(spark):
    from martcraft.plans import crm
    rows = [("brand_a", "hot", f"o{i}", f"product {i % 50:02d}") for i in range(3000)]
    rows += [("brand_a", f"m{i}", f"x{i}", f"product {i % 7:02d}") for i in range(200)]
    mem = spark.createDataFrame(rows, "mall string, member_id string, order_id string, a_product string")
    top = crm.top_products(mem)
    got = {r.member_id: r.products for r in top.collect()}
    pdf = pd.DataFrame(rows, columns=["mall", "member_id", "order_id", "a_product"])
    exp = pdf.groupby("member_id").a_product.apply(lambda s: ",".join(sorted(set(s))[:3])).to_dict()
    assert got == exp
