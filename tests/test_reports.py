"""The report export: five sheets from one pass over the fact, the same rows as the analyses."""

import os
import sys

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

from plan_report import explain  # noqa: E402

from conftest import SF_SMALL  # noqa: E402
from ledgerline.plans import analyses as A  # noqa: E402
from ledgerline.plans.model import build_model  # noqa: E402
from ledgerline.sources import io  # noqa: E402


def _scans(df, table):
    return sum(line.startswith("Location:") and f"/{table}]" in line for line in explain(df).splitlines())


def test_five_sheets_share_one_scan_of_the_fact(spark, monkeypatch):
    m = build_model(spark, SF_SMALL, reuse=False)
    written = {}
    plain = A.materialize

    def watched(df, name, *args):
        written[name] = df
        return plain(df, name, *args)

    monkeypatch.setattr(A, "materialize", watched)
    sheets = A.report_views(m)
    assert list(sheets) == list(io.REPORTS)
    assert list(written) == ["report-totals"] and _scans(written["report-totals"], "fct_vendas") == 1
    assert {s: _scans(df, "fct_vendas") for s, df in sheets.items()} == {s: int(s == "painel") for s in sheets}


def test_sheets_are_the_analyses(spark, model):
    m = build_model(spark, SF_SMALL, reuse=False)  # its curve is made by the sheets
    for sheet, df in A.report_views(m).items():
        want = getattr(A, io.REPORTS[sheet])(model)
        assert df.dtypes == want.dtypes, sheet
        assert sorted(map(repr, df.collect())) == sorted(map(repr, want.collect())), sheet


def test_sheets_of_a_lazy_model(spark, model):
    lazy = build_model(spark, SF_SMALL, materialized=False, reuse=False)
    got, want = A.report_views(lazy)["por_mes"].collect(), A.monthly_trend(model).collect()
    assert sorted(map(repr, got)) == sorted(map(repr, want))
