"""Run the whole job: raw exports -> model -> checks -> exports.

    python -m ledgerline --sales vendas.csv --products produtos.csv --customers clientes.csv --out out/
    python -m ledgerline --testdata /root/testdata/sf0.01 --out out/
    spark-submit --master yarn ... (the same arguments)

Master, memory, partitions and ``spark.checkpoint.dir`` come from the session or spark-submit.

Writes the model as Parquet (``out/model``), the panel as CSV (``out/painel.csv``) and the six
report sheets (``out/reports``); prints the (small) check results.
"""

from __future__ import annotations

import argparse

from .plans import analyses
from .plans.model import build_model, build_model_from_raw
from .session import job_session, scratch_root
from .sources import io
from .views import CHECKS, views


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(prog="ledgerline")
    ap.add_argument("--sales")
    ap.add_argument("--products")
    ap.add_argument("--customers")
    ap.add_argument("--testdata", help="folder with the TPC-H-like test tables instead of CSV exports")
    ap.add_argument("--out", required=True)
    ap.add_argument("--multiline", action="store_true", help="fields of the exports may hold line breaks")
    args = ap.parse_args(argv)

    spark = job_session()
    scratch_root(spark)
    if args.testdata:
        m = build_model(spark, args.testdata)
    else:
        if not (args.sales and args.products and args.customers):
            ap.error("give --sales, --products and --customers, or --testdata")
        m = build_model_from_raw(spark, io.read_raw_exports(spark, args.sales, args.products, args.customers, args.multiline))

    for name, check in CHECKS.items():
        print(f"== {name}")
        check(m).show(truncate=False)

    out = args.out.rstrip("/")
    v = views(m)
    io.export_model({k: v[k] for k in ("dim_produto", "dim_cliente", "dim_vendedor", "dim_tempo", "fct_vendas")}, f"{out}/model")
    io.export_panel_csv(v["painel"], f"{out}/painel.csv")
    io.export_reports(analyses.report_views(m), f"{out}/reports")
    print(f"written under {out}")


if __name__ == "__main__":
    main()
