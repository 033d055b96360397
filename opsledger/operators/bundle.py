"""Export bundle operators: previews, trailing-window slices, source manifest
and the mart bundle checks (S08-S10, Q17, Q19).

Checks are one-row aggregates unioned into a single (check, status) frame, so
the whole audit runs as one job; the gate (:func:`raise_on_fail`) is a
driver-side look at that small result, taken after the audit is written.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterable, Iterator
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.semantics import broadcast_if_small
from ..sources import blocks
from .kpi import ADDITIVE

#: Bytes up to which a file is one cell of a row; in its task such a cell takes a few times its bytes.
WHOLE = 32 << 20
#: Larger files whose tasks are one stage: each task gets the plans of all files of its stage.
TOGETHER = 100
# Grain register of the bundle, dataset -> unique, non-null keys.
KEYS = {
    "store_dimension": ["restaurant_id"],
    "store_month_kpis": ["restaurant_id", "month"],
    "store_day": ["restaurant_id", "business_date"],
    "store_hour": ["restaurant_id", "business_date", "hour"],
    "product_month": ["restaurant_id", "month", "product_id", "channel"],
    "customer_segment_summary": ["restaurant_id", "segment"],
    "customer_cohorts": ["restaurant_id", "cohort_month"],
    "promotion_effectiveness": ["promotion_id"],
    "forecast_daily": ["restaurant_id", "business_date"],
    "forecast_backtests": ["restaurant_id", "business_date", "model", "origin_date"],
    "forecast_plot": ["restaurant_id", "business_date"],
    "labour_plan": ["restaurant_id", "business_date", "hour"],
    "weekly_performance": ["restaurant_id", "window_end"],
}
def preview(df: DataFrame, keys: list[str], n: int = 100) -> DataFrame:
    """First ``n`` rows in key order (S08): a deterministic top-k, not a sample."""
    return df.orderBy(*keys).limit(n)


def trailing_days(df: DataFrame, days: int = 92, date_col: str = "business_date") -> DataFrame:
    """Rows of the last ``days`` days ending at the table's latest date.

    The cut-off is resolved first as one scalar (a max over the date column
    only), so the filter reaches the scan as a literal: it is pushed into the
    Parquet reader (row-group skipping) and prunes date partitions."""
    last = df.agg(F.max(date_col)).first()[0]
    if last is None:
        return df.limit(0)
    return df.filter(F.col(date_col) >= F.date_sub(F.lit(last), days - 1))


def trailing_months(df: DataFrame, daily: DataFrame, days: int = 92, month_col: str = "month") -> DataFrame:
    """Monthly rows from the month of the daily cut-off onwards."""
    start = daily.agg(F.date_format(F.date_sub(F.max("business_date"), days - 1), "yyyy-MM")).first()[0]
    if start is None:
        return df.limit(0)
    return df.filter(F.col(month_col) >= F.lit(start))


def _digested(files: list[tuple[str, str, int, bytes]]):
    """A partition's blocks, with its file's (table, file, bytes, rest), to the file's row of the manifest."""

    def digested(part: int, content: Iterable[bytes]) -> Iterator[tuple[str, str, int, str]]:
        table, file, length, rest = files[part]
        digest, seen = hashlib.sha256(), len(rest)
        for block in content:
            digest.update(block)
            seen += len(block)
        digest.update(rest)
        if seen != length:
            raise OSError(f"{table}/{file} has {length} bytes, {seen} were read")
        yield table, file, length, digest.hexdigest()

    return digested


def source_manifest(spark: SparkSession, folder: str, names: list[str], whole: int = WHOLE) -> DataFrame:
    """(table, file, bytes, sha256) of every input file (S10); each file is hashed
    by one task, files are spread over the cluster.

    A file of at most ``whole`` bytes (or one block) is one cell. A larger one passes through its task
    block by block, so memory doesn't grow with it."""
    whole = max(whole, blocks.BLOCK)

    def scan(paths: list[str]) -> DataFrame:
        files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(paths)
        name = F.regexp_extract(F.col("path"), r"/([^/]+)\.parquet(/.*)?$", 1)
        return files.withColumns({"table": name, "file": F.regexp_extract(F.col("path"), r"([^/]+)$", 1)})

    def hashed(files: DataFrame) -> DataFrame:
        return files.select("table", "file", F.col("length").alias("bytes"), F.sha2(F.col("content"), 256).alias("sha256"))

    files = scan([os.path.join(folder, f"{n}.parquet") for n in names])
    out = hashed(files.filter(F.col("length") <= whole))
    large = files.filter(F.col("length") > whole).select("path", "table", "file", "length").collect()
    with ThreadPoolExecutor(8) as pool:  # planning takes the driver some 0.1 s a file, one after the other
        parts = list(pool.map(lambda r: blocks.file_blocks(spark, r["path"], r["length"]), large))
    packed = [blocks.pattern(r["path"]) for r, part in zip(large, parts) if part is None]
    if packed:
        out = out.unionByName(hashed(scan(packed)))
    streamed = [(r, *part) for r, part in zip(large, parts) if part is not None]
    for start in range(0, len(streamed), TOGETHER):
        some = streamed[start : start + TOGETHER]
        rows = spark.sparkContext.union([content for _, content, _ in some]).mapPartitionsWithIndex(
            _digested([(r["table"], r["file"], r["length"], rest) for r, _, rest in some])
        )
        manifest = spark.createDataFrame(rows, out.schema)
        out = out.unionByName(manifest.repartition(1) if len(streamed) > TOGETHER else manifest)  # a row a file: ends the stage
    return out


def _checks(df: DataFrame, breaches: dict[str, F.Column]) -> DataFrame:
    """One row per named count of breaches: (check_name, status). One aggregate for all of them."""
    names = list(breaches)
    counted = df.agg(*[F.coalesce(c, F.lit(0)).cast("long").alias(f"c{i}") for i, c in enumerate(breaches.values())])
    rows = F.array(*[F.struct(F.lit(n).alias("check_name"), F.col(f"c{i}").alias("n")) for i, n in enumerate(names)])
    status = F.when(F.col("x.n") == 0, "PASS").otherwise("FAIL")
    return counted.select(F.explode(rows).alias("x")).select("x.check_name", status.alias("status"))


def key_checks(name: str, df: DataFrame, keys: list[str], sites: DataFrame) -> DataFrame:
    """Keys without nulls or repeats, and only known sites, of one mart in one grouping (Q02, Q03)."""
    known = broadcast_if_small(sites.select(F.col("restaurant_id").alias("_site"), F.lit(True).alias("_known")))
    seen = df.select(*{*keys, "restaurant_id"}).join(known, F.col("restaurant_id") == F.col("_site"), "left")
    grouped = seen.groupBy(*keys).agg(F.count("*").alias("_n"), F.count_if(F.col("_known").isNull()).alias("_lost"))
    no_null = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    return _checks(
        grouped,
        {
            f"{name}: key": F.count_if(~no_null | (F.col("_n") > 1)),
            f"{name}: site": F.sum("_lost"),
        },
    )


def _tolerance(df: DataFrame, measure: str) -> float:
    """Counts must agree exactly, amounts and hours to a hundredth."""
    return 0.0 if dict(df.dtypes)[measure] in ("int", "bigint") else 0.01 + 1e-9


def monthly_checks(monthly: DataFrame, daily: DataFrame) -> DataFrame:
    """Every additive measure of the monthly mart against the sum of the days, in one join."""
    keys = ["restaurant_id", "month"]
    summed = daily.groupBy(*keys).agg(*[F.sum(m).alias(f"_{m}") for m in ADDITIVE])
    both = monthly.select(*keys, *ADDITIVE).join(summed, keys, "full_outer")
    off = {}
    for m in ADDITIVE:
        close = F.abs(F.col(m) - F.col(f"_{m}")) <= _tolerance(daily, m)
        off[f"store_month_kpis: {m} equals the days"] = F.count_if(~F.coalesce(close, F.lit(False)))
    return _checks(both, off)


def total_checks(marts: dict[str, DataFrame]) -> DataFrame:
    """Totals of finer marts against the daily ledger, as signed contributions to one sum each."""
    pairs = [("product_month", "revenue"), ("store_hour", "revenue"), ("store_hour", "paid_hours")]
    parts = []
    for mart, m in pairs:
        name = F.lit(f"{mart}: {m} equals the days").alias("check_name")
        parts += [marts[mart].agg(F.sum(m).alias("v")).select(name, "v"), marts["store_day"].agg((-F.sum(m)).alias("v")).select(name, "v")]
    stacked = reduce(DataFrame.unionByName, parts)
    close = F.abs(F.sum(F.coalesce("v", F.lit(0.0)))) <= 0.01 + 1e-9
    return stacked.groupBy("check_name").agg(F.when(close, "PASS").otherwise("FAIL").alias("status"))


def backtest_checks(traces: DataFrame) -> DataFrame:
    """Forecast days follow their origin; every validation day lies before every holdout day."""
    day = lambda period: F.when(F.col("evaluation_period") == period, F.col("business_date"))
    ordered = F.max(day("Validation")) < F.min(day("Holdout"))
    return _checks(
        traces,
        {
            "forecast_backtests: days follow the origin": F.count_if(F.col("business_date") <= F.col("origin_date")),
            "forecast_backtests: holdout comes last": F.when(ordered, 0).otherwise(1),
        },
    )


def bundle_checks(marts: dict[str, DataFrame], sites: DataFrame) -> DataFrame:
    """Audit of a mart bundle (Q17): check_name, status."""
    ids = sites.select("restaurant_id").distinct()
    parts = [key_checks(name, df, KEYS[name], ids) for name, df in marts.items() if name in KEYS]
    parts += [monthly_checks(marts["store_month_kpis"], marts["store_day"]), total_checks(marts), backtest_checks(marts["forecast_backtests"])]
    return reduce(DataFrame.unionByName, parts)


def raise_on_fail(checks: DataFrame) -> None:
    """Gate (Q19): raise if any check failed (call after the audit is written)."""
    failed = [r["check_name"] for r in checks.filter(F.col("status") != "PASS").select("check_name").collect()]
    if failed:
        raise ValueError(f"bundle checks failed: {sorted(failed)}")
