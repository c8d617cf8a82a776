"""``spark-submit`` entry point of the backfill.

    spark-submit -m tripmill.jobs.backfill --source ... --table ... \\
        --cab-type green --backfill-year 2024 --backfill-month 06
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence
from dataclasses import asdict

from tripmill.plans.backfill import ALL, BackfillReport, backfill
from tripmill.schemas import CAB_TYPES
from tripmill.session import build_session


def parse(argv: Sequence[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(description="Land the pending days of a source slice")
    parser.add_argument("--source", required=True, help="root of cab_type=/year=/month=/day=")
    parser.add_argument("--table", required=True, help="root of the landed table")
    parser.add_argument("--ledger", required=True)
    parser.add_argument("--rejects", required=True)
    parser.add_argument("--cab-type", required=True, choices=CAB_TYPES)
    parser.add_argument("--backfill-year", required=True)
    parser.add_argument("--backfill-month", default=ALL)
    parser.add_argument("--backfill-day", default=ALL)
    parser.add_argument("--batch-id")
    return parser.parse_args(argv)


def run(options: argparse.Namespace) -> BackfillReport:
    def part(value: str) -> str | None:
        return None if value == ALL else value

    return backfill(
        build_session(),
        source=options.source,
        table=options.table,
        ledger=options.ledger,
        rejects=options.rejects,
        cab_type=options.cab_type,
        year=options.backfill_year,
        month=part(options.backfill_month),
        day=part(options.backfill_day),
        batch_id=options.batch_id,
    )


if __name__ == "__main__":
    print(asdict(run(parse())))
