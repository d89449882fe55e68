"""``python -m territory RAW_FOLDER TARGET_FOLDER [VERSION]``"""

from __future__ import annotations

import sys

from pyspark.sql import SparkSession

from territory.operators.quality import QualityError
from territory.plans.warehouse import refresh
from territory.session import folder_bytes, tune


def main(folder: str, target: str, version: str = "1") -> int:
    """Exit code of a refresh: 1 if a data-quality rule keeps it from being published."""
    spark = SparkSession.builder.appName("territory").getOrCreate()
    tune(spark, folder_bytes(spark, folder))
    try:
        refresh(spark, folder, target, int(version))
    except QualityError as violated:
        print(f"not published: {violated}", file=sys.stderr)
        return 1
    return 0


if __name__ == "__main__":
    sys.exit(main(*sys.argv[1:]))
