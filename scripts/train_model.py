"""Train and evaluate the attrition model from an exported dataset CSV.

    python scripts/train_model.py <dataset_dir> <model_dir> [--bigint-ids]

Split (exact, stratified), fit the whole pipeline on the training rows,
print split sizes, accuracy, confusion counts and the classification
report, and save the fitted pipeline under <model_dir>.
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import types as T  # noqa: E402

from attrition.plans.summary import split_summary  # noqa: E402
from attrition.plans.training import save_model, train_from_csv  # noqa: E402
from attrition.session import get_spark  # noqa: E402


def main(argv: list[str]) -> None:
    data, model_dir = argv[1], argv[2]
    key = T.LongType() if "--bigint-ids" in argv else T.StringType()
    spark = get_spark()
    result = train_from_csv(spark, data, key_type=key)
    split_summary(result.split).orderBy("split", "label").show()
    result.accuracy.show()
    result.confusion.orderBy("truth", "predicted").show()
    result.report.show(truncate=False)
    save_model(result.model, model_dir)
    print(f"model saved to {model_dir}")


if __name__ == "__main__":
    main(sys.argv)
