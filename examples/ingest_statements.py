"""Landed statement / calendar fetch units -> four tables, as a stream.

    python examples/ingest_statements.py <landed_units_dir> <tables_root>

Units are JSON lines ``{"seq", "kind", "symbol", "status", "body"}`` with kind
income, balance, cashflow or calendar; a failed fetch has a status text and no
body and is recorded in ``fetch_errors``.
"""

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from marketlake.session import get_session  # noqa: E402
from marketlake.sources.statements import read_units_stream  # noqa: E402
from marketlake.streaming.pipeline import StatementTableSink, pipeline  # noqa: E402
from marketlake.streaming.tables import KeyedTable  # noqa: E402

TABLES = ("quarterly_income_statements", "quarterly_balance_sheets", "quarterly_cashflow_statements",
          "calendar_dates")


def main(landed: str, root: str) -> None:
    spark = get_session()
    handle = pipeline(spark, lambda s, cap: read_units_stream(s, landed, max_files_per_trigger=cap),
                      StatementTableSink(root)).checkpoint(f"{root}/_checkpoint").start().wait()
    if handle.error:
        raise SystemExit(f"pipeline failed: {handle.error}")
    for name in TABLES:
        print(name, KeyedTable(spark, root, name).read().count())


if __name__ == "__main__":
    main(sys.argv[1], sys.argv[2])
