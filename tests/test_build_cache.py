"""A model is built once for the same input files, and anew when one of them changes under its name."""

import shutil

from conftest import SF_SMALL
from ledgerline.plans.model import build_model
from ledgerline.sources.fixture import TABLES, table_path
from ledgerline.sources.scratch import files_digest


def _copy(tmp_path):
    for t in TABLES:
        shutil.copyfile(table_path(SF_SMALL, t), tmp_path / f"{t}.parquet")
    return str(tmp_path)


def test_a_file_rewritten_under_its_name_gives_a_new_model(spark, tmp_path):
    import pyarrow.parquet as pq

    folder = _copy(tmp_path)
    first = build_model(spark, folder)
    assert build_model(spark, folder) is first
    path = table_path(folder, "part")
    pq.write_table(pq.read_table(path).slice(0, 150), path)
    second = build_model(spark, folder)
    assert second is not first and second["dim_produto"].count() == 150
    assert build_model(spark, folder) is second


def test_digest_opens_no_file_and_sees_every_change(spark, tmp_path):
    for i in range(3):
        (tmp_path / f"f{i}.bin").write_bytes(b"x" * (i + 1))
    seen = files_digest(spark, [str(tmp_path)])
    assert seen[:2] == (3, 6) and files_digest(spark, [str(tmp_path)]) == seen
    (tmp_path / "f1.bin").write_bytes(b"wxyz")
    changed = files_digest(spark, [str(tmp_path)])
    assert changed[:2] == (3, 8) and changed[2:] != seen[2:]
    files = spark.read.format("binaryFile").load(str(tmp_path)).select("path", "length", "modificationTime")
    plan = files._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan.split("ReadSchema")[1]
