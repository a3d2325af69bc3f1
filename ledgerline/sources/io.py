"""Sources and sinks (S1-S5): the raw CSV exports in, the model and reports out.

Everything is a distributed read or write: no result passes through the driver.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Column layout of the three ERP exports (all text) and their field separators.
RAW_SALES_COLUMNS = [
    "numero_pedido", "sequencia_item", "data_pedido", "codigo_cliente", "codigo_produto", "quantidade",
    "preco_unitario", "desconto_pct", "frete_cobrado", "custo_frete_real", "vendedor", "status",
]
RAW_PRODUCT_COLUMNS = ["codigo_produto", "descricao", "categoria", "unidade", "custo_unitario", "preco_tabela", "ativo"]
RAW_CUSTOMER_COLUMNS = [
    "codigo_cliente", "razao_social", "cnpj", "segmento", "regiao", "vendedor", "data_cadastro", "limite_credito",
]
SEPARATORS = {"raw_vendas": ";", "raw_produtos": ";", "raw_clientes": ","}
LAYOUTS = {"raw_vendas": RAW_SALES_COLUMNS, "raw_produtos": RAW_PRODUCT_COLUMNS, "raw_clientes": RAW_CUSTOMER_COLUMNS}


def read_raw_csv(spark: SparkSession, path: str, columns: list[str], sep: str, multiline: bool = False) -> DataFrame:
    """A headed CSV export with every column read as text, so nothing is guessed from the data.

    Columns are bound by the names in the header, in whatever order the file has them; columns
    that are not asked for are dropped, and a missing one is an error.  All files of a folder must
    have the same header.  A row with too few or too many fields stops the job (FAILFAST), as it
    does in the reference.  Empty and ``""`` fields read as NULL; a doubled quote inside quotes is
    one quote.

    ``multiline`` allows line breaks inside quoted fields; files are then not split between tasks.
    Without it such a row is broken in two, which stops the job as well.
    """
    options = {"header": True, "sep": sep, "quote": '"', "escape": '"', "multiLine": multiline}
    found = spark.read.options(**options).csv(path).columns  # reads the header line only
    missing = [c for c in columns if c not in found]
    if missing:
        raise ValueError(f"{path}: the header has no column {', '.join(missing)}; it has {', '.join(found)}")
    schema = T.StructType([T.StructField(c, T.StringType(), True) for c in found])
    rows = (
        spark.read.schema(schema).options(**options)
        # The whole row is parsed whatever is selected, and every file's header is compared.
        .option("mode", "FAILFAST").option("enforceSchema", False).option("columnPruning", False)
        .csv(path)
    )
    return rows.select(*columns)


def read_raw_sales(spark: SparkSession, path: str, multiline: bool = False) -> DataFrame:
    """Sales items export (``;``)."""
    return read_raw_csv(spark, path, RAW_SALES_COLUMNS, SEPARATORS["raw_vendas"], multiline)


def read_raw_products(spark: SparkSession, path: str, multiline: bool = False) -> DataFrame:
    """Products export (``;``)."""
    return read_raw_csv(spark, path, RAW_PRODUCT_COLUMNS, SEPARATORS["raw_produtos"], multiline)


def read_raw_customers(spark: SparkSession, path: str, multiline: bool = False) -> DataFrame:
    """Customers export (``,``)."""
    return read_raw_csv(spark, path, RAW_CUSTOMER_COLUMNS, SEPARATORS["raw_clientes"], multiline)


def read_raw_exports(
    spark: SparkSession, sales: str, products: str, customers: str, multiline: bool = False
) -> dict[str, DataFrame]:
    return {
        "raw_vendas": read_raw_sales(spark, sales, multiline),
        "raw_produtos": read_raw_products(spark, products, multiline),
        "raw_clientes": read_raw_customers(spark, customers, multiline),
    }


def _csv_writer(df: DataFrame, sep: str = ",", codec: str = "none"):
    # Keep blanks at the ends of the text: they are part of the dirty data.
    return (
        df.write.mode("overwrite")
        .option("compression", codec)
        .option("header", True)
        .option("sep", sep)
        .option("quote", '"')
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
    )


def write_raw_exports(raw: Mapping[str, DataFrame], folder: str) -> dict[str, str]:
    """Write raw tables as CSV exports in the ERP's layout (``;`` or ``,``); returns the paths."""
    paths = {}
    for name, df in raw.items():
        path = f"{folder.rstrip('/')}/{name}"
        _csv_writer(df.select(*LAYOUTS[name]), SEPARATORS[name]).csv(path)
        paths[name] = path
    return paths


def export_model(tables: Mapping[str, DataFrame], folder: str) -> dict[str, str]:
    """S3: every table of the model as Parquet under ``folder``."""
    paths = {}
    for name, df in tables.items():
        path = f"{folder.rstrip('/')}/{name}"
        df.write.mode("overwrite").parquet(path)
        paths[name] = path
    return paths


def plain_number(v: Column) -> Column:
    """A double as plain decimal text: the shortest digits that give the double back, a point and
    at least one decimal.  ``inf`` and ``nan`` are written so; beyond 10^38, and nearer to zero than
    10^-14, no amount is written out and the text stays scientific."""
    x = v.cast("double")
    size, text = F.abs(x), x.cast("string")
    digits = lambda t: F.regexp_replace(x.try_cast(t).cast("string"), "(\\.\\d+?)0*$", "$1")
    return (
        F.when(F.isnan(x), F.lit("nan"))
        .when(size == float("inf"), F.when(x > 0, F.lit("inf")).otherwise(F.lit("-inf")))
        .when(((size >= 1e-3) & (size < 1e7)) | (size == 0), text)
        .when((size >= 1) & (size < 1e20), digits("decimal(38,18)"))
        .when((size >= 1e20) & (size < 1e38), F.concat(digits("decimal(38,0)"), F.lit(".0")))
        .when((size >= 1e-14) & (size < 1), digits("decimal(38,30)"))
        .otherwise(text)
    )


def _plain_columns(df: DataFrame) -> DataFrame:
    doubles = {f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))}
    return df.select(*[plain_number(F.col(c)).alias(c) if c in doubles else F.col(c) for c in df.columns])


def export_panel_csv(panel: DataFrame, path: str, codec: str = "none") -> None:
    """The panel as headed CSV (a folder of part files), numbers in plain decimals.

    As text it is more than four times the exports that it comes from: ``codec`` (``gzip``)
    compresses the part files."""
    _csv_writer(_plain_columns(panel), codec=codec).csv(path)


def as_report_text(df: DataFrame) -> DataFrame:
    """Dates as ``yyyy-MM-dd`` text, numbers as plain decimals and every NULL as empty text, as the
    spreadsheet export has them."""
    cols = []
    for f in _plain_columns(df).schema.fields:
        c = F.col(f.name)
        if isinstance(f.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd")
        cols.append(F.coalesce(c.cast("string"), F.lit("")).alias(f.name))
    return _plain_columns(df).select(*cols)


# Report sheet -> the analysis that it shows, as exported by the reference.
REPORTS = {
    "painel": "panel",
    "por_categoria": "margin_by_category",
    "por_mes": "monthly_trend",
    "por_desconto": "discount_bands",
    "clientes": "customer_abc",
    "frete": "freight_subsidy",
}


def export_reports(views: Mapping[str, DataFrame], folder: str, codec: str = "none") -> dict[str, str]:
    """The six report sheets as text CSV folders (re-aimed from a spreadsheet upload); ``codec`` as
    for the panel."""
    paths = {}
    for sheet, view in views.items():
        path = f"{folder.rstrip('/')}/{sheet}"
        _csv_writer(as_report_text(view), codec=codec).csv(path)
        paths[sheet] = path
    return paths
