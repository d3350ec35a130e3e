"""Build the feature dataset and export it as CSV.

    python scripts/export_dataset.py <sf_dir> <output_dir> [--sql-rules]

Reads the driver test tables of <sf_dir>, derives the six source tables,
builds the 25-column export (script rules unless --sql-rules) and writes it
as CSV under <output_dir>; prints the run summary.
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from attrition.plans.dataset import export_dataset  # noqa: E402
from attrition.plans.features import SCRIPT_OPTIONS, FeatureOptions  # noqa: E402
from attrition.session import get_spark  # noqa: E402
from attrition.sources.testtables import TEST_REF, TEST_START, load_tables  # noqa: E402


def main(argv: list[str]) -> None:
    sf_dir, out = argv[1], argv[2]
    options = FeatureOptions() if "--sql-rules" in argv else SCRIPT_OPTIONS
    spark = get_spark()
    summary = export_dataset(load_tables(spark, sf_dir), out, TEST_REF, TEST_START, options=options)
    summary.show(truncate=False)


if __name__ == "__main__":
    main(sys.argv)
