"""Print the AQE final physical plan (formatted) of one registered query after running it.

Usage: python tools/explain.py <query> [sf_dir]
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tillstar.queries import QUERIES  # noqa: E402
from tillstar.session import build_session  # noqa: E402


def main() -> None:
    name = sys.argv[1]
    sf_dir = sys.argv[2] if len(sys.argv) > 2 else "/root/testdata/sf0.1"
    spark = build_session("local[8]", 8)
    df = QUERIES[name](spark, sf_dir)
    df.write.format("noop").mode("overwrite").save()
    df.explain("formatted")


if __name__ == "__main__":
    main()
