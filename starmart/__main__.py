"""Command line: load the warehouse, run reports, retry rejects, compact.

    python -m starmart load    --warehouse DIR --customers CSV --products CSV --transactions DIR [--stream]
    python -m starmart report  --warehouse DIR [--year 2017] [--out DIR] [q01_top_products_daytype ...]
    python -m starmart retry   --warehouse DIR --retry-id -1000
    python -m starmart compact --warehouse DIR [--upto-batch 41] --months 2017-01 2017-02

``report`` writes one CSV folder per report under ``--out`` (or shows the
first rows), like sending the report SQL file to a client and saving the
results. With ``--stream`` the transactions folder is consumed by the
Structured Streaming loader (``availableNow``, bounded micro-batches);
without it, the files are loaded as one batch.
"""

from __future__ import annotations

import argparse
import sys

from starmart.plans import diagnostics, reports
from starmart.session import get_spark
from starmart.sources import files
from starmart.sources.warehouse import Warehouse
from starmart.streaming.loader import WarehouseLoader
from starmart.streaming.pipeline import DEFAULT_TRIGGER_BYTES, run_to_completion


def _print_rows(df, limit: int | None) -> None:
    """Print a report row by row, one partition at a time on the driver."""
    print("\t".join(df.columns))
    for i, row in enumerate(df.toLocalIterator()):
        if i == limit:
            print(f"... cut after {limit} rows")
            break
        print("\t".join("" if v is None else str(v) for v in row))


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="python -m starmart")
    sub = p.add_subparsers(dest="cmd", required=True)
    ld = sub.add_parser("load", help="load master data and transactions")
    ld.add_argument("--warehouse", required=True)
    ld.add_argument("--customers")
    ld.add_argument("--products")
    ld.add_argument("--transactions")
    ld.add_argument("--format", default="csv")
    ld.add_argument("--stream", action="store_true")
    ld.add_argument("--max-files-per-trigger", type=int)
    ld.add_argument("--max-bytes-per-trigger", default=DEFAULT_TRIGGER_BYTES)
    ld.add_argument("--checkpoint")
    ld.add_argument("--batch-id", type=int, help="batch id of a one-shot load; by default a new one, above all of a stream's")
    rp = sub.add_parser("report", help="run reports (all by default)")
    rp.add_argument("--warehouse", required=True)
    rp.add_argument("--year", type=int, default=reports.DEFAULT_YEAR)
    rp.add_argument("--out")
    rp.add_argument("--format", default="csv")
    rp.add_argument("--rows", type=int, help="print so many rows of a report at most; by default all")
    rp.add_argument("names", nargs="*")
    rt = sub.add_parser("retry", help="retry open rejects against the current dimensions")
    rt.add_argument("--warehouse", required=True)
    rt.add_argument("--retry-id", type=int, required=True)
    rt.add_argument("--everything", action="store_true", help="all open rejects, not only those that wait for arrived keys")
    cp = sub.add_parser("compact", help="merge committed batch folders of some months")
    cp.add_argument("--warehouse", required=True)
    cp.add_argument("--upto-batch", type=int, help="by default all finished batches")
    cp.add_argument("--months", nargs="+", required=True, help="yyyy-mm")
    return p


def main(argv: list[str] | None = None, spark=None) -> dict:
    args = _parser().parse_args(argv)
    spark = spark or get_spark()
    wh = Warehouse(spark, args.warehouse).create()
    out: dict = {}
    if args.cmd == "load":
        loader = WarehouseLoader(wh)
        loader.load_masters(files.read_customers(spark, args.customers) if args.customers else None,
                            files.read_products(spark, args.products) if args.products else None)
        if args.transactions:
            if args.stream:
                run_to_completion(spark, wh, args.transactions, checkpoint_location=args.checkpoint,
                                  fmt=args.format, max_files_per_trigger=args.max_files_per_trigger,
                                  max_bytes_per_trigger=args.max_bytes_per_trigger, loader=loader)
            else:
                loader.load_files(args.transactions, args.format, args.batch_id)
        out["masters"] = [(r.table, r.read, r.stored, r.existing, r.duplicates, r.rejected) for r in loader.master_reports]
        out["batches"] = [(r.batch_id, r.loaded, r.rejected) for r in loader.reports]
    elif args.cmd == "report":
        star = wh.star()
        catalog = {**reports.REPORTS, **diagnostics.DIAGNOSTICS}
        for name in args.names or list(reports.REPORTS):
            fn = catalog[name]
            df = fn(star, year=args.year) if name in reports.YEAR_PARAM else fn(star)
            if args.out:
                files.export(df, f"{args.out.rstrip('/')}/{name}", args.format)
            else:
                print(f"-- {name}")
                _print_rows(df, args.rows)
            out[name] = True
    elif args.cmd == "retry":
        r = WarehouseLoader(wh).retry_rejects(args.retry_id, args.everything)
        out["resolved"] = r.loaded
    elif args.cmd == "compact":
        months = [tuple(int(x) for x in m.split("-")) for m in args.months]
        out["staging"] = wh.compact_facts(months, args.upto_batch)
    print({k: v for k, v in out.items() if k != "staging" or v})
    return out


if __name__ == "__main__":
    main(sys.argv[1:])
    sys.exit(0)
