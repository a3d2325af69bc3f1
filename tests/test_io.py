"""Sources and sinks: CSV exports in, model and reports out (round trips)."""

import tempfile

import duckdb
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from ledgerline.plans import analyses as A
from ledgerline.plans.model import build_model_from_raw
from ledgerline.sources import io
from ledgerline.sources.fixture import raw_tables


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_csv_exports_round_trip_to_same_model(spark, model):
    folder = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    paths = io.write_raw_exports(raw_tables(spark, SF_SMALL), folder)
    raw = io.read_raw_exports(spark, paths["raw_vendas"], paths["raw_produtos"], paths["raw_clientes"])
    # Blanks and text survive the CSV; the empty CNPJ comes back as NULL, as in the reference.
    orig = raw_tables(spark, SF_SMALL)
    assert _rows(raw["raw_vendas"]) == _rows(orig["raw_vendas"])
    assert _rows(raw["raw_produtos"]) == _rows(orig["raw_produtos"])
    fixed = orig["raw_clientes"].withColumn("cnpj", F.when(F.col("cnpj") != "", F.col("cnpj")))
    assert _rows(raw["raw_clientes"]) == _rows(fixed)
    m = build_model_from_raw(spark, raw, materialized=False)
    assert _rows(A.margin_by_category(m)) == _rows(A.margin_by_category(model))


def test_model_and_reports_export(spark, model):
    folder = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    paths = io.export_model({k: model[k] for k in ("dim_tempo", "fct_vendas")}, folder + "/model")
    assert spark.read.parquet(paths["fct_vendas"]).count() == model["fct_vendas"].count()
    io.export_panel_csv(A.panel(model), folder + "/painel_csv")
    back = spark.read.option("header", True).csv(folder + "/painel_csv")
    assert back.count() == A.panel(model).count()
    views = {sheet: getattr(A, fn)(model) for sheet, fn in io.REPORTS.items()}
    out = io.export_reports(views, folder + "/reports")
    sheet = spark.read.option("header", True).csv(out["por_mes"])
    assert sheet.count() == 80
    painel = spark.read.option("header", True).csv(out["painel"])
    assert painel.filter(~F.col("data").rlike(r"^\d{4}-\d{2}-\d{2}$")).count() == 0
    first = spark.read.option("header", True).csv(out["por_mes"]).orderBy("ano_mes").first()
    assert first.var_receita_pct is None  # written as empty text, read back as NULL


def test_views_answer_sql_under_reference_names(spark, model):
    from ledgerline.views import register_views

    names = register_views(model)
    assert {"an_categoria", "painel", "fct_vendas", "dim_tempo"} <= set(names)
    top = spark.sql("SELECT categoria, margem_pct FROM an_categoria ORDER BY margem_contribuicao LIMIT 1").first()
    assert top.margem_pct == -18.7  # the worst category at sf0.001 (FIXTURES.md)
    assert len(spark.table("fct_vendas").columns) == 19


def test_command_line_run(spark):
    from ledgerline.__main__ import main

    out = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    main(["--testdata", SF_SMALL, "--out", out])
    assert spark.read.parquet(out + "/model/fct_vendas").count() == 3676
    assert spark.read.option("header", True).csv(out + "/reports/por_categoria").count() == 6


def _write(text):
    folder = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    with open(f"{folder}/in.csv", "w", newline="") as f:
        f.write(text)
    return f"{folder}/in.csv"


COLUMNS = ["codigo_produto", "descricao", "categoria"]


def _duck(path, sep=";"):
    names = ", ".join(COLUMNS)
    return sorted(duckdb.connect().execute(
        f"SELECT {names} FROM read_csv('{path}', delim='{sep}', header=true, all_varchar=true, quote='\"', escape='\"')"
    ).fetchall(), key=repr)


@pytest.mark.parametrize("text", [
    "codigo_produto;descricao;categoria\nP1;Caneta;A\nP2;;B\n",
    "descricao;categoria;codigo_produto\nCaneta;A;P1\n\"a;b \"\"c\"\"\";B;P2\n",
    "extra;descricao;categoria;codigo_produto\nx;Caneta;A;P1\n",
])
def test_columns_are_bound_by_name(spark, text):
    path = _write(text)
    assert _rows(io.read_raw_csv(spark, path, COLUMNS, ";")) == _duck(path)


def test_line_breaks_in_fields(spark):
    path = _write("descricao;codigo_produto;categoria\n\"two\nlines\";P1;A\nx;P2;B\n")
    assert _rows(io.read_raw_csv(spark, path, COLUMNS, ";", multiline=True)) == _duck(path)
    with pytest.raises(Exception, match="FAILFAST|MALFORMED"):
        io.read_raw_csv(spark, path, COLUMNS, ";").collect()


@pytest.mark.parametrize("row", ["P1;Caneta", "P1;Caneta;A;B", "P1"])
def test_rows_of_another_length_stop_the_job(spark, row):
    path = _write(f"codigo_produto;descricao;categoria\nP0;x;y\n{row}\n")
    for select in (COLUMNS, ["codigo_produto"]):
        with pytest.raises(Exception, match="FAILFAST|MALFORMED"):
            io.read_raw_csv(spark, path, COLUMNS, ";").select(*select).collect()


def test_missing_column_is_an_error(spark):
    with pytest.raises(ValueError, match="categoria"):
        io.read_raw_csv(spark, _write("codigo_produto;descricao\nP1;x\n"), COLUMNS, ";")


def test_files_of_a_folder_have_one_header(spark):
    folder = _write("codigo_produto;descricao;categoria\nP1;x;y\n").rpartition("/")[0]
    with open(f"{folder}/other.csv", "w") as f:
        f.write("descricao;codigo_produto;categoria\nx;P1;y\n")
    with pytest.raises(Exception, match="(?i)header"):
        io.read_raw_csv(spark, folder, COLUMNS, ";").collect()


NUMBERS = [
    (12345678.9, "12345678.9"), (250000000.0, "250000000.0"), (0.0001, "0.0001"), (-1.5e-7, "-0.00000015"), (1e17, "100000000000000000.0"),
    (1.25, "1.25"), (-0.0, "-0.0"), (0.0, "0.0"), (1e7, "10000000.0"), (1234567890123.45, "1234567890123.45"), (-98765432.1, "-98765432.1"),
    (float("inf"), "inf"), (float("-inf"), "-inf"), (float("nan"), "nan"), (None, None), (1e22, "10000000000000000000000.0"),
    (0.001, "0.001"), (0.00099, "0.00099"), (123456789.0, "123456789.0"),
]


def test_numbers_are_written_in_plain_decimals(spark):
    df = spark.createDataFrame([(i, v) for i, (v, _) in enumerate(NUMBERS)], "i int, v double")
    got = [r.t for r in df.select("i", io.plain_number(F.col("v")).alias("t")).orderBy("i").collect()]
    assert got == [t for _, t in NUMBERS]
    text = io.as_report_text(df).orderBy(F.col("i").cast("int")).collect()
    assert [r.v for r in text] == [t or "" for _, t in NUMBERS]


def test_a_given_session_keeps_its_settings(spark):
    from ledgerline.session import job_session

    before = {k: spark.conf.get(k, None) for k in ("spark.master", "spark.sql.shuffle.partitions", "spark.driver.memory")}
    assert job_session() is spark or job_session().conf.get("spark.app.id") == spark.conf.get("spark.app.id")
    assert {k: spark.conf.get(k, None) for k in before} == before


def test_the_job_sets_no_cluster_options():
    import inspect

    from ledgerline import __main__, session

    text = inspect.getsource(__main__) + inspect.getsource(session.job_session)
    assert not any(w in text for w in (".master(", "shuffle.partitions", "driver.memory\"", "local["))


@pytest.mark.parametrize("master,path,fine", [
    ("yarn", None, False), ("yarn", "/tmp/x", False), ("local-cluster[2,1,512]", "/tmp/x", False), ("yarn", "hdfs://n/x", True),
    ("spark://h:7077", "file:///mnt/shared", True), ("local[4]", "/tmp/x", True),
])
def test_scratch_folder_has_to_be_shared(spark, monkeypatch, master, path, fine):
    from ledgerline import session

    values = {"spark.master": master, "spark.checkpoint.dir": path}

    class Conf:
        def get(self, key, default=None):
            return values.get(key) or default

    class Session:
        conf, sparkContext = Conf(), spark.sparkContext

    if fine:
        assert session.scratch_root(Session()) == path
    else:
        with pytest.raises(RuntimeError, match="shared"):
            session.scratch_root(Session())


@pytest.mark.parametrize("shared,taken_up,fine", [(True, True, True), (False, True, False), (True, False, False)])
def test_scratch_folder_without_a_scheme_is_tried_out_on_a_cluster(spark, tmp_path, shared, taken_up, fine):
    from ledgerline import session
    from ledgerline.sources import io
    from ledgerline.sources.scratch import materialize

    path = str(tmp_path / "kept")
    values = {"spark.master": "spark://h:7077", "spark.checkpoint.dir": path, "spark.app.id": f"app-{path}".replace("/", "_")}

    class Conf:
        def get(self, key, default=None):
            return values.get(key) or default

    class Context:
        defaultParallelism, _jsc = 4, spark.sparkContext._jsc

        def getCheckpointDir(self):
            return f"file:{path}/0a1b" if taken_up else None

    class Session:
        conf, sparkContext, _jvm, _jsc, read = Conf(), Context(), spark._jvm, spark._jsc, spark.read

        def range(self, start, end, step, tasks):
            # What machines with a disk of their own write is not there afterwards.
            return spark.range(start, end, step, tasks) if shared else spark.range(start, end, step, tasks).filter("id % 2 = 0")

    if not fine:
        with pytest.raises(RuntimeError, match="shared"):
            session.scratch_root(Session())
        return
    assert session.scratch_root(Session()) == path and session.scratch_root(Session()) == path
    assert not list((tmp_path / "kept").rglob("probe-*"))
    folder = session.new_scratch_dir(Session(), "csv")
    raw = spark.createDataFrame([("P000001", "x", "A", "UN", "1.00", "2,00", "S")], io.RAW_PRODUCT_COLUMNS)
    written = io.write_raw_exports({"raw_produtos": materialize(raw, "raw", f"{folder}/raw")}, folder)["raw_produtos"]
    assert folder.startswith(path) and io.read_raw_products(spark, written).collect() == raw.collect()


@pytest.mark.parametrize("spelled", ["{}//kept", "{}/kept/", "{}/./kept", "{}/other/../kept"])
def test_scratch_folder_may_be_spelled_in_any_way(spark, tmp_path, spelled):
    from ledgerline import session

    path = spelled.format(tmp_path)
    values = {"spark.master": "spark://h:7077", "spark.checkpoint.dir": path, "spark.app.id": f"app-{hash(path)}"}

    class Conf:
        def get(self, key, default=None):
            return values.get(key) or default

    class Context:
        defaultParallelism, _jsc = 4, spark.sparkContext._jsc

        def getCheckpointDir(self):
            return f"file:{tmp_path}/kept/0a1b"

    class Session:
        conf, sparkContext, _jvm, _jsc, read, range = Conf(), Context(), spark._jvm, spark._jsc, spark.read, spark.range

    assert session.scratch_root(Session()) == path


def test_applications_share_no_folder_below_the_shared_one():
    """A folder that one user's application makes there is closed to the next user's."""
    from ledgerline import session

    def at(app):
        class Session:
            class conf:
                @staticmethod
                def get(key, default=None):
                    return {"spark.master": "local[2]", "spark.checkpoint.dir": "/shared", "spark.app.id": app}.get(key, default)

        return session.new_scratch_dir(Session(), "csv").removeprefix("/shared/").split("/")

    first, second = at("app-1"), at("app-2")
    assert len(first) == 2 and first[0] != second[0]


@pytest.mark.parametrize("at_start,shared,fine", [("/own/disk", True, True), (None, True, True), ("/own/disk", False, False)])
def test_scratch_folder_may_be_set_by_the_program(spark, tmp_path, at_start, shared, fine):
    """``setCheckpointDir`` on a cluster whose default setting is a folder on each machine, or none."""
    from ledgerline import session

    values = {"spark.master": "spark://h:7077", "spark.checkpoint.dir": at_start, "spark.app.id": f"app-{hash(tmp_path)}"}

    class Conf:
        def get(self, key, default=None):
            return values.get(key) or default

    class Context:
        defaultParallelism, _jsc = 4, spark.sparkContext._jsc

        def getCheckpointDir(self):
            return f"file:{tmp_path}/kept/0a1b"

        def getConf(self):
            return Conf()

    class Session:
        conf, sparkContext, _jvm, _jsc, read = Conf(), Context(), spark._jvm, spark._jsc, spark.read

        def range(self, start, end, step, tasks):
            return spark.range(start, end, step, tasks) if shared else spark.range(start, end, step, tasks).filter("id % 2 = 0")

    if not fine:
        with pytest.raises(RuntimeError, match="shared"):
            session.scratch_root(Session())
        return
    assert session.new_scratch_dir(Session(), "csv").startswith(f"file:{tmp_path}/kept/ledgerline-app-")
    values["spark.checkpoint.dir"] = str(tmp_path / "kept")
    assert session.scratch_root(Session()) == str(tmp_path / "kept")


def test_scratch_folder_may_be_a_relative_path(spark, monkeypatch):
    from ledgerline import session

    here = spark._jvm.java.lang.System.getProperty("user.dir")
    values = {"spark.master": "spark://h:7077", "spark.checkpoint.dir": "mnt/kept", "spark.app.id": "app-1"}
    monkeypatch.setattr(session, "_SHARED", {("app-1", f"{here}/mnt/kept")})  # tried out already

    class Conf:
        def get(self, key, default=None):
            return values.get(key) or default

    class Context:
        _jsc = spark.sparkContext._jsc

        def getCheckpointDir(self):
            return f"file:{here}/mnt/kept/0a1b"

    class Session:
        conf, sparkContext, _jvm, _jsc = Conf(), Context(), spark._jvm, spark._jsc

    assert session.scratch_root(Session()) == f"{here}/mnt/kept"
