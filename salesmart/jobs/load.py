"""spark-submit: append the CSV files that are not staged yet."""

from __future__ import annotations

import argparse

from salesmart.session import build_session, scan_bytes, size_shuffles
from salesmart.sinks.tables import load_csv


def main() -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("source", help="CSV file, folder or glob")
    parser.add_argument("staging", help="folder of the staging table")
    args = parser.parse_args()
    spark = build_session("load sales")
    size_shuffles(spark, scan_bytes(spark.read.text(args.source)))
    audit = load_csv(spark, args.source, args.staging)
    print(
        f"{audit.files} files, {audit.rows_read} rows: "
        f"{audit.rows_loaded} loaded, {audit.rows_rejected} set aside"
    )
    spark.stop()


if __name__ == "__main__":
    main()
