"""Print the formatted physical plans of the headline queries.

usage: python scripts/plans.py [sf_dir] > PLANS.txt
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from ranklight.plans import registry  # noqa: E402
from ranklight.session import get_session  # noqa: E402


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = get_session("local[8]", shuffle_partitions=16)
    registry.load_all()
    for name in registry.HEADLINE:
        df = registry.QUERIES[name](spark, sf_dir)
        print(f"===== {name}")
        df.explain("formatted")


if __name__ == "__main__":
    main()
