"""Build the models of a data directory into an output folder.

    python -m ledgerline --data /root/testdata/sf0.01 --out /shared/models [--only a,b]

The two model chains (paid periods -> years/months/quarters; client base -> reports) are
written as stored chains; every other registered query is written as its own table.  The
session is the platform's (``spark-submit -m ledgerline ...``), sized by the input.  On a
cluster, ``--out`` must be a folder every executor can reach.
"""

from __future__ import annotations

import argparse
import os
import time

from ledgerline import catalog
from ledgerline.plans.chain import run_paid_chain, run_report_chain
from ledgerline.session import apply_scale_conf, platform_session
from ledgerline.sources.tables import input_bytes, save, saved_folder

CHAINED = {
    "merge_intervals", "rejected_intervals", "paid_years", "paid_months", "paid_quarters",
    "client_base", "tiers", "client_report", "last_payroll_service", "last_acc_service",
}


def main(argv: list[str] | None = None, spark=None) -> dict[str, str]:
    """Build the models; returns name -> Parquet folder of the version written.  A session passed in is left running."""
    parser = argparse.ArgumentParser(prog="python -m ledgerline")
    parser.add_argument("--data", required=True, help="folder with the input tables")
    parser.add_argument("--out", required=True, help="folder for the model tables")
    parser.add_argument("--only", default="", help="comma-separated query names")
    parser.add_argument("--master", default=None, help="Spark master, for a run without spark-submit")
    args = parser.parse_args(argv)

    owned = spark is None
    if owned:
        spark = platform_session(args.master)
        apply_scale_conf(spark, input_bytes(spark, args.data))
    only = {n for n in args.only.split(",") if n}
    fx = catalog._fx(spark, args.data)
    done: dict[str, str] = {}
    t = time.perf_counter()
    if not only or only & {
        "merge_intervals", "rejected_intervals", "paid_years", "paid_months", "paid_quarters"
    }:
        done.update(run_paid_chain(
            fx["contracts"], fx["contract_items"], fx["sku_for_tickets"], fx["financial_years"],
            args.out,
        ))
    if not only or only & {"client_base", "tiers", "client_report", "last_payroll_service",
                           "last_acc_service"}:
        done.update(run_report_chain(
            fx["dim_contracts"], fx["dim_contract_items"], fx["fact_products"],
            fx["dim_companies"], fx["dim_subscriptions"], fx["white_label"], fx["connections"],
            fx["transactions"], fx["fact_financial_years"], fx["positions"],
            fx["dim_companies_lambda"], catalog.REPORT_AS_OF, catalog.LINK_PREFIX, args.out,
        ))
    for name, fn in sorted(catalog.QUERIES.items()):
        if name in CHAINED or (only and name not in only):
            continue
        path = os.path.join(args.out, name)
        save(fn(spark, args.data), path)
        done[name] = saved_folder(spark, path)
    print(f"wrote {len(done)} tables to {args.out} in {time.perf_counter() - t:.1f}s")
    if owned:
        spark.stop()
    return done


if __name__ == "__main__":
    main()
