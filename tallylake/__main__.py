"""Run the batch from the command line: ``python -m tallylake --output-dir PATH``.

The relational source is taken from DB_HOST, DB_PORT, DB_NAME, DB_USER and
DB_PASSWORD, the document source from MONGO_URI and MONGO_DB.
"""

from __future__ import annotations

import argparse
import os
from collections.abc import Sequence

from pyspark.sql import SparkSession

from tallylake import schema as S
from tallylake.plans import batch
from tallylake.session import DOCUMENT_PACKAGE, RELATIONAL_PACKAGE, build_session
from tallylake.sources import documents, files, relational
from tallylake.workspace import discard, new_folder


def live_tables(
    spark: SparkSession, source: relational.RelationalSource, parts: int, equal_depth: bool = False
) -> S.Tables:
    """All five live sources; the relational scans are cut over their keys."""
    place = relational.key_cuts if equal_depth else relational.key_range

    def table(name: str):
        cut = place(spark, source, name, parts)
        return relational.read_table(spark, source, name, cut)

    return S.Tables(
        members=table(S.MEMBER),
        accounts=table(S.ACCOUNT),
        cards=table(S.CARD),
        movements=table(S.MOVEMENT),
        interactions=documents.read_collection(spark),
    )


def parse(argv: Sequence[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="tallylake", description=__doc__)
    parser.add_argument("--output-dir", required=True, help="folder for all outputs")
    parser.add_argument("--run-id", help="record the quality figures under this name")
    parser.add_argument("--snapshot-dir", help="keep the copy of the sources here; default: none is kept")
    parser.add_argument("--parts", type=int, default=32, help="parallel reads per table")
    parser.add_argument(
        "--equal-depth",
        action="store_true",
        help="cut the tables at quantiles of their keys: for keys with gaps or crowded ranges",
    )
    parser.add_argument(
        "--shuffle-partitions",
        type=int,
        required=True,
        help="first number of shuffle partitions: about the size of the transactions / 256 MB",
    )
    parser.add_argument("--no-csv", action="store_true", help="skip the CSV form of the flat view")
    parser.add_argument("--strict", action="store_true", help="hide card numbers, printed names, e-mails")
    parser.add_argument("--snowflake", action="store_true", help="write the snowflake tables too")
    parser.add_argument("--dashboards", action="store_true", help="write the dashboard tables too")
    return parser.parse_args(argv)


def main(argv: Sequence[str] | None = None) -> batch.Outcome:
    options = parse(argv)
    source = relational.RelationalSource.from_environment()
    uri = os.environ.get("MONGO_URI", "mongodb://localhost:27017")
    database = os.environ.get("MONGO_DB")
    spark = build_session(
        packages=[RELATIONAL_PACKAGE, DOCUMENT_PACKAGE],
        document_uri=f"{uri}/{database}" if database else uri,
        shuffle_partitions=options.shuffle_partitions,
    )
    snapshot = options.snapshot_dir or new_folder(spark, "snapshot")
    try:
        tables = files.land(live_tables(spark, source, options.parts, options.equal_depth), snapshot)
        outcome = batch.run(
            tables,
            options.output_dir,
            options.run_id,
            with_csv=not options.no_csv,
            strict=options.strict,
            with_snowflake=options.snowflake,
        )
        if options.dashboards:
            batch.write_dashboards(spark, options.output_dir)
    finally:
        # the copy holds personal data in clear: only a folder the user named is kept
        if not options.snapshot_dir:
            discard(spark, snapshot)
    print(f"{outcome.flat_rows} rows in the flat view, outputs in {outcome.layout.root}")
    return outcome


if __name__ == "__main__":
    main()
