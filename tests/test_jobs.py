import json
import os
import tempfile

from mercato.plans import jobs
from tests import fixtures as fx


def _dump(df, path):
    with open(path, "w") as f:
        json.dump([r.asDict(recursive=True) for r in df.collect()], f)


def test_end_to_end_jobs(spark):
    raw = tempfile.mkdtemp(prefix="mercato-raw-")
    _dump(fx.users(spark), os.path.join(raw, "users.json"))
    _dump(fx.products(spark), os.path.join(raw, "products.json"))
    _dump(fx.categories(spark), os.path.join(raw, "categories.json"))
    _dump(fx.transactions(spark), os.path.join(raw, "transactions.json"))
    _dump(fx.sessions(spark), os.path.join(raw, "sessions_0.json"))
    out = tempfile.mkdtemp(prefix="mercato-out-")
    counts = jobs.curate(spark, raw, os.path.join(out, "curated"))
    assert counts == {"products": 4, "users": 4, "transactions": 8}
    b = jobs.batch_reports(spark, raw, os.path.join(out, "reports"))
    assert b["product_affinity"].count() > 0
    s = jobs.sql_reports(spark, raw, os.path.join(out, "reports"))
    assert s["sql_conversion_funnel"].count() == 4
    c = jobs.clv_job(spark, raw, os.path.join(out, "curated"), os.path.join(out, "reports"))
    assert sum(r.user_count for r in c["clv_tier_summary"].collect()) == 3
    for name in ["product_affinity", "cohort_analysis", "sql_top_users", "clv_tier_summary"]:
        files = os.listdir(os.path.join(out, "reports", name))
        assert sum(f.endswith(".csv") for f in files) >= 1
