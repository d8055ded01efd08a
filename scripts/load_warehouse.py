"""Run the warehouse load into a new run folder.

    python scripts/load_warehouse.py /root/testdata/sf0.01 /tmp/wh-out
"""

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from cardspark.plans.load import build_warehouse  # noqa: E402
from cardspark.session import build_session  # noqa: E402

if __name__ == "__main__":
    # spark-submit names the master; a plain python run is local
    spark = build_session(os.environ.get("MASTER", "local[*]"))
    out = build_warehouse(spark, sys.argv[1], sys.argv[2])
    print(out)
    spark.read.parquet(f"{out['run']}/verify").groupBy("status").count().show()
