"""Readers of raw files and contracts that they must meet. What talks to the outside writes raw files; these read them."""

from __future__ import annotations

import io
import json
import os
import zipfile
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from asofia import schemas
from asofia.functions.dates import compact_date
from asofia.functions.text import delisting_outcome, is_amendment, payout_amount, plain_text, report_key, ticker6

OK_STATUS = ("000", "013")


class SourceError(ValueError):
    pass


def filings(spark: SparkSession, path: str) -> DataFrame:
    """Payloads, one a file; a status other than found or empty is an error when it is read."""
    rows = spark.read.schema(schemas.FILING).option("multiLine", True).json(path).withColumn("file", F.input_file_name())
    return rows.withColumn("status", F.when(F.col("status").isin(*OK_STATUS), F.col("status")).otherwise(F.raise_error(F.concat(F.lit("status "), F.coalesce("status", F.lit("none")), F.lit(" in "), F.col("file")))))


def with_fallback(rows: DataFrame) -> DataFrame:
    """Filings that hold lines: of a ticker's year and report the separate ones count only where no consolidated one has any."""
    key = ["ticker", "bsns_year", "reprt_code"]
    filled = rows.filter(F.size("list") > 0)
    whole = filled.filter(F.col("statement_basis") == "CFS").select(*key).distinct()
    return filled.filter(F.col("statement_basis") == "CFS").unionByName(filled.filter(F.col("statement_basis") != "CFS").join(whole, key, "left_anti").select(*filled.columns))


def prices_csv(spark: SparkSession, path: str) -> DataFrame:
    """Tickers stay strings, dates are parsed."""
    return spark.read.schema("date date, ticker string, close double, cap double, volume double").option("header", True).csv(path).withColumn("ticker", ticker6(F.col("ticker")))


def labels(spark: SparkSession, path: str) -> DataFrame:
    """Golden labels, one a line; a first line of remarks is skipped. An unknown confidence is an error."""
    rows = spark.read.schema(T.StructType([*schemas.LABELS, T.StructField("_meta", T.StringType())])).json(path).filter("_meta IS NULL AND ticker IS NOT NULL").drop("_meta")
    sure = F.coalesce("confidence", F.lit("certain"))
    return rows.withColumn("confidence", F.when(sure.isin("certain", "contested"), sure).otherwise(F.raise_error(F.concat(F.lit("confidence "), sure))))


def one_label_each(*files: DataFrame) -> DataFrame:
    """Label files as one; a ticker in two of them is an error."""
    rows = files[0]
    for f in files[1:]:
        rows = rows.unionByName(f)
    if twice := [r["ticker"] for r in rows.groupBy("ticker").count().filter("count > 1").limit(5).collect()]:
        raise SourceError(f"labelled twice: {', '.join(sorted(twice))}")
    return rows


def documents(spark: SparkSession, path: str) -> DataFrame:
    """rcept_no and plain text of zipped filings: the file of that name, else the largest; UTF-8, else EUC-KR, else CP949."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            names = [p.rsplit("/", 1)[-1].rsplit(".", 1)[0] for p in b.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(names), pa.array([main_document(n, c) for n, c in zip(names, b.column(1).to_pylist())])], ["rcept_no", "markup"])

    raw = spark.read.format("binaryFile").option("pathGlobFilter", "*.zip").load(path).select("path", "content")
    return raw.mapInArrow(run, "rcept_no string, markup string").select("rcept_no", plain_text(F.col("markup")).alias("text"))


def main_document(name: str, content: bytes) -> str:
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        files = [i for i in z.infolist() if not i.is_dir()]
        if not files:
            raise SourceError(f"{name}: empty archive")
        chosen = next((i for i in files if i.filename.rsplit("/", 1)[-1] == f"{name}.xml"), None) or max(files, key=lambda i: i.file_size)
        return decode(z.read(chosen))


def decode(raw: bytes) -> str:
    for codec in "utf-8 euc-kr cp949".split():
        try:
            return raw.decode(codec)
        except UnicodeDecodeError:
            continue
    return raw.decode("cp949", "replace")


def html_table(raw: bytes, required: tuple[str, ...], least_rows: int = 1000, least_bytes: int = 1000) -> list[dict[str, str]]:
    """Rows of the first table with the required columns; a short answer is an error, not an empty table."""
    from html.parser import HTMLParser

    if len(raw) < least_bytes:
        raise SourceError(f"only {len(raw)} bytes")

    class Parser(HTMLParser):
        def __init__(self) -> None:
            super().__init__()
            self.rows, self.cell = [], None

        def handle_starttag(self, tag, attrs):
            if tag == "tr":
                self.rows.append([])
            elif tag in ("td", "th"):
                self.cell = []

        def handle_data(self, data):
            if self.cell is not None:
                self.cell.append(data)

        def handle_endtag(self, tag):
            if tag in ("td", "th") and self.cell is not None and self.rows:
                self.rows[-1].append(" ".join("".join(self.cell).split()))
                self.cell = None

    p = Parser()
    p.feed(decode(raw))
    head = next((k for k, r in enumerate(p.rows) if set(required) <= set(r)), None)
    if head is None:
        raise SourceError(f"no table with {', '.join(required)}")
    out = [dict(zip(p.rows[head], r)) for r in p.rows[head + 1 :] if len(r) == len(p.rows[head])]
    if len(out) < least_rows:
        raise SourceError(f"only {len(out)} rows")
    return out


def html_tables(spark: SparkSession, path: str, required: tuple[str, ...], least_rows: int = 1000) -> DataFrame:
    """file and row (a map) of the tables in HTML files."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for p, c in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                rows = html_table(c, required, least_rows)
                yield pa.RecordBatch.from_arrays([pa.array([p] * len(rows)), pa.array([list(r.items()) for r in rows], pa.map_(pa.string(), pa.string()))], ["file", "row"])

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInArrow(run, "file string, row map<string,string>")


def delistings(raw: DataFrame, group: str = "주권") -> DataFrame:
    """Of the given security group, dated, classified, one row a ticker and date."""
    rows = raw.filter((F.col("secu_group") == group) & F.col("delisting_date").isNotNull()).withColumn("ticker", ticker6(F.col("ticker")))
    return rows.withColumn("outcome", delisting_outcome(F.col("reason"), F.col("name"))).dropDuplicates(["ticker", "delisting_date"])


def disclosures(raw: DataFrame) -> DataFrame:
    return raw.withColumn("report_key", report_key(F.col("report_nm"))).withColumn("is_amendment", is_amendment(F.col("report_nm"))).withColumn("rcept_dt", compact_date(F.col("rcept_dt").cast("string")))


def assert_complete(rows: DataFrame, expected: int) -> DataFrame:
    """A paged list must be whole."""
    if (n := rows.count()) != expected:
        raise SourceError(f"{n} rows of {expected}")
    return rows


def dividends(raw: DataFrame, lag_days: int = 1) -> DataFrame:
    """Annual facts from payout tables (ticker, rcept_no, label, stock_kind, value): reported as '-' is 0, not reported is nothing; preferred lines are left out."""
    label = F.regexp_replace(F.coalesce("label", F.lit("")), r"\s", "")
    element = F.when(label.contains("주당현금배당금"), "DPS").when(label.contains("현금배당수익률"), "DIV_YIELD_REPORTED").when(label.contains("현금배당성향"), "PAYOUT_RATIO").when(label.contains("현금배당금총액"), "DIV_TOTAL_REPORTED")
    common = F.coalesce(F.trim("stock_kind"), F.lit("")).isin("보통주", "-", "") | ~element.isin("DPS", "DIV_YIELD_REPORTED")
    rows = raw.withColumn("element", element).filter(F.col("element").isNotNull() & common)
    one = rows.groupBy("ticker", "rcept_no", "element").agg(F.min_by("value", "ord").alias("value"))
    reported = compact_date(F.col("rcept_no"))
    return one.select("ticker", "element", F.coalesce(payout_amount(F.col("value")), F.lit(0.0)).alias("value"), reported.alias("reported_at"), F.date_add(reported, lag_days).alias("available_at"), F.col("rcept_no").alias("source_doc_id"))


def owner_stakes(raw: DataFrame) -> DataFrame:
    """ticker, stake: the total's row where there is one, else the sum of the holders."""
    total = F.regexp_replace(F.coalesce("holder", F.lit("")), r"\s", "").isin("계", "합계", "소계")
    v = payout_amount(F.col("value"))
    return raw.groupBy("ticker", "rcept_no").agg(F.coalesce(F.max(F.when(total, v)), F.sum(F.when(~total, v))).alias("stake")).filter("stake IS NOT NULL")


def write_packs(packs: DataFrame, path: str) -> None:
    packs.write.mode("overwrite").json(path)


def _fs(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path if "://" in path else "file://" + os.path.abspath(path))


def write_text(path: str, text: str) -> None:
    """A small artefact, on any file system that has a URI."""
    fs, at = _fs(path)
    fs.create_dir(at.rpartition("/")[0], recursive=True)
    with fs.open_output_stream(at) as f:
        f.write(text.encode())


def write_json(path: str, value: object) -> None:
    """A manifest, a basket, quality figures."""
    write_text(path, json.dumps(value, ensure_ascii=False, indent=1, default=str))


def read_json(path: str) -> object:
    """What write_json left, or nothing."""
    fs, at = _fs(path)
    if not fs.get_file_info(at).is_file:
        return None
    with fs.open_input_stream(at) as f:
        return json.loads(f.read())


def log_line(path: str, **fields: object) -> None:
    with open(path, mode="a", encoding="utf-8") as log:
        print(json.dumps(fields, default=str, ensure_ascii=False), file=log)


def save_basket(path: str, tickers: list[str], rebalanced_at: str) -> None:
    write_json(path, {"tickers": sorted(tickers), "rebalanced_at": rebalanced_at})


def load_basket(path: str) -> tuple[set[str], str | None]:
    """An old basket is a bare list without a date."""
    got = read_json(path)
    if got is None:
        return set(), None
    return (set(got), None) if isinstance(got, list) else (set(got["tickers"]), got.get("rebalanced_at"))
