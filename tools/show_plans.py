"""Print the formatted physical plans of the main jobs (adapter, feature
table, key-level statistics) for a data folder, to check the README's plan
claims by eye: pushed filters, pruned schemas, exchanges, broadcasts.
These are the plans before execution; exchange reuse (``ReusedExchange``)
shows in the executed plan, see tests/test_plans.py.

    python tools/show_plans.py /root/testdata/sf0.01
"""

import sys

sys.path.insert(0, __file__.rsplit("/tools/", 1)[0])

from sessionlab.operators.features import build_features  # noqa: E402
from sessionlab.plans.explain import plan_string  # noqa: E402
from sessionlab.plans.workspace import workspace  # noqa: E402
from sessionlab.session import get_spark  # noqa: E402
from sessionlab.sources.adapter import load_clicks  # noqa: E402


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = get_spark("local[4]", 8)
    ws = workspace(spark, sf_dir)
    jobs = {
        "adapter (events -> click log)": load_clicks(spark, sf_dir),
        "feature table (train split, 85 features)": build_features(ws.split("train"), rates=ws.rates()),
    }
    for title, df in jobs.items():
        print(f"\n===== {title}\n")
        print(plan_string(df, "formatted"))
    spark.stop()


if __name__ == "__main__":
    main()
