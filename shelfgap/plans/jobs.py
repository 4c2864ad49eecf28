"""The ingest job of one dataset, the recommendation job, and both in order."""

from __future__ import annotations

import hashlib
import inspect
import re
import threading
import uuid
from collections.abc import Callable, Mapping
from concurrent.futures import FIRST_EXCEPTION, ThreadPoolExecutor, wait
from dataclasses import dataclass, replace
from functools import partial, reduce
from typing import Any

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfgap import specs
from shelfgap.functions import parsing
from shelfgap.operators import cleaning, keyed, quality
from shelfgap.operators.cleaning import RAW, clean
from shelfgap.operators.quality import accepted, counted, judge, observed, rejected
from shelfgap.operators.scoring import recommend
from shelfgap.operators.toplists import (
    company_top_items,
    competitor_top_items,
    item_dimension,
)
from shelfgap.plans.config import (
    RESULT_SECTION,
    DatasetPaths,
    JobConfig,
    Options,
    ResultPaths,
)
from shelfgap.sources.ledger import files_digest, input_files, literal_path, new_files, note_files
from shelfgap.sources.staging import Staging
from shelfgap.sources.tables import read_table, table_exists, upsert_table, write_table
from shelfgap.sources.text import MALFORMED, read_text, write_text
from shelfgap.specs import DATASETS, DatasetSpec, RECOMMENDATION_SCHEMA

LOAD_DAY, DELIVERY = "load_day", "delivery"


@dataclass(frozen=True)
class IngestReport:
    input_rows: int
    good_rows: int
    rejected_rows: int
    unjudged_rows: int
    failed_rules: int
    malformed_rows: int = 0
    new_files: int | None = None  # of an incremental ingest


@dataclass(frozen=True)
class RecommendationReport:
    """Rows of the three tables, of the two top lists and of the result."""

    seller_catalog: int
    company_sales: int
    competitor_sales: int
    company_top_items: int
    competitor_top_items: int
    recommendations: int


def flat_quarantine(quarantine: DataFrame) -> DataFrame:
    """CSV has no nested columns: the raw values get columns of their own."""
    if RAW not in quarantine.columns:
        return quarantine
    fields = quarantine.schema[RAW].dataType.names
    raw = [F.col(RAW)[name].alias(f"{RAW}_{name}") for name in fields]
    return quarantine.select(*[c for c in quarantine.columns if c != RAW], *raw)


def ingest(
    spark: SparkSession,
    spec: DatasetSpec,
    paths: DatasetPaths,
    options: Options = Options(),
    preview: bool = False,
) -> IngestReport:
    """CSV to keyed table and quarantine.

    The cleaned and judged rows are staged once and counted as they are written; table and
    quarantine read that copy, so they agree and the text is parsed one time. If a run fails after
    that, the next one over the same files goes on from the copy. The table is left alone if no row
    is good. An incremental ingest reads the files that no earlier one has read, and changes nothing
    if there are none.
    """
    with Staging(spark) as staging:
        source, number = paths.input, None
        files = input_files(spark, paths.input)
        if options.incremental:
            # As many names as the delivery has files, which the driver has to list anyway.
            files = staging.save(new_files(spark, paths.input, paths.ledger))
            source = [literal_path(r["path"]) for r in files.select("path").collect()]
            number = len(source)
            if not source:
                return IngestReport(0, 0, 0, 0, 0, 0, 0)
        malformed = MALFORMED if options.malformed == "quarantine" else None
        raw = read_text(spark, source, options.line_breaks, malformed)
        digest = files_digest(files)
        if paths.bronze:
            raw = _bronze(raw, paths.bronze, options, digest)
        report = _judged_into_table(staging, raw, spec, paths, options, digest, preview)
        if options.incremental:
            note_files(files, paths.ledger)
    return replace(report, new_files=number)


def _day(options: Options) -> Column:
    return F.current_date() if options.as_of is None else F.lit(options.as_of).cast("date")


def _bronze(raw: DataFrame, path: str, options: Options, delivery: str) -> DataFrame:
    """The raw text as a copy of it gives it back: of the whole input, or, if the ingest is
    incremental, of this delivery, in a folder of its own below that of the day it was loaded."""
    spark = raw.sparkSession
    if not options.incremental:
        raw.write.mode("overwrite").parquet(path)
        return spark.read.parquet(path)
    # A delivery that is read again, because its run failed, replaces itself.
    named = raw.withColumns({LOAD_DAY: _day(options), DELIVERY: F.lit(delivery)})
    writer = named.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(LOAD_DAY, DELIVERY).parquet(path)
    kept = spark.read.schema(named.schema).parquet(path)
    return kept.where((F.col(LOAD_DAY) == _day(options)) & (F.col(DELIVERY) == delivery)).select(*raw.columns)


def bronze_day(spark: SparkSession, path: str, day: str) -> DataFrame:
    """The text loaded on a day, from the files of that day alone; a column that some of its
    deliveries lack is NULL there."""
    reader = spark.read.option("basePath", path).option("mergeSchema", True)
    return reader.parquet(f"{path}/{LOAD_DAY}={day}").drop(LOAD_DAY, DELIVERY)


def replay(
    spark: SparkSession, spec: DatasetSpec, paths: DatasetPaths, day: str, options: Options = Options()
) -> IngestReport:
    """Upserts again what was loaded on a day, from the bronze copy. The rules look at ``as_of`` of
    the options, else at that day."""
    options = replace(options, write="upsert", as_of=options.as_of or day)
    with Staging(spark) as staging:
        digest = files_digest(input_files(spark, f"{paths.bronze}/{LOAD_DAY}={day}"))
        raw = bronze_day(spark, paths.bronze, day)
        return _judged_into_table(staging, raw, spec, paths, options, digest)


def _judged_into_table(
    staging: Staging,
    raw: DataFrame,
    spec: DatasetSpec,
    paths: DatasetPaths,
    options: Options,
    inputs: str,
    preview: bool = False,
) -> IngestReport:
    spark = staging.spark
    seen = None

    def judged_rows() -> DataFrame:
        nonlocal seen
        cleaned = clean(raw, spec, options.dates, options.keep_raw, options.as_of)
        rows, seen = observed(judge(cleaned, spec.rules, options.as_of, options.null_policy))
        return rows

    today = spark.range(1).select(_day(options).cast("string")).first()[0]
    parameters = repr((paths.table, spec, today, options, raw.columns))
    name = hashlib.sha256(f"{inputs} {_no_addresses(parameters)} {_code()}".encode()).hexdigest()[:32]
    judged, kept = staging.step(f"{spec.name}-{name}", judged_rows)
    report = IngestReport(**(counted(judged) if kept else seen.get))
    good = accepted(judged).select(*spec.columns)
    if preview:
        raw.show(5, truncate=False)
        good.show(5, truncate=False)
    if report.good_rows:
        if options.write == "upsert" and table_exists(spark, paths.table):
            upsert_table(good, paths.table, spec, options.table_format, options.evolve)
        else:
            write_table(good, paths.table, spec, options.table_format)
    bad = rejected(judged, distinct_rows=spec.one_row_per_key_before_rules)
    if options.quarantine_format == "parquet":
        bad.write.mode("overwrite").parquet(paths.quarantine)
    else:
        write_text(flat_quarantine(bad), paths.quarantine)
    return report


def _code() -> str:
    """The code that rows pass on their way to the staged copy."""
    return "".join(inspect.getsource(module) for module in (cleaning, keyed, parsing, quality, specs))


def _no_addresses(text: str) -> str:
    """The same for the same declarations in every process."""
    return re.sub(r" at 0x[0-9a-f]+", "", text)


def recommendations(
    seller_catalog: DataFrame,
    company_sales: DataFrame,
    competitor_sales: DataFrame,
    staging: Staging,
    options: Options = Options(),
) -> DataFrame:
    """Tables to the result, in the result's declared types."""
    items = item_dimension(seller_catalog, unit_price=options.price_basis == "unit")
    found = recommend(
        seller_catalog,
        company_top_items(company_sales, items, options.top_n),
        competitor_top_items(competitor_sales, items, options.top_n),
        staging,
        price_basis=options.price_basis,
    )
    return _declared(found)


def _declared(found: DataFrame) -> DataFrame:
    return found.select(*[F.col(f.name).cast(f.dataType) for f in RECOMMENDATION_SCHEMA])


def _counted(**parts: DataFrame) -> DataFrame:
    """One row with the number of rows of each part, in one job."""
    counts = [df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(k).alias("part"), "n") for k, df in parts.items()]
    return reduce(DataFrame.unionByName, counts).groupBy().pivot("part", list(parts)).sum("n")


def recommend_with_report(
    tables: Mapping[str, DataFrame], staging: Staging, options: Options = Options()
) -> tuple[DataFrame, DataFrame]:
    """The result, and one row of counts of what it was made of; both start from the staged top
    lists and the staged result, so nothing is computed for the counts alone."""
    items = item_dimension(tables["seller_catalog"], unit_price=options.price_basis == "unit")
    company = staging.save(company_top_items(tables["company_sales"], items, options.top_n))
    competitor = staging.save(competitor_top_items(tables["competitor_sales"], items, options.top_n))
    found = recommend(
        tables["seller_catalog"], company, competitor, staging, price_basis=options.price_basis
    )
    result = staging.save(_declared(found))
    counts = _counted(
        **tables, company_top_items=company, competitor_top_items=competitor, recommendations=result
    )
    return result, counts


def run_recommendation(
    spark: SparkSession, paths: ResultPaths, options: Options = Options(), preview: bool = False
) -> RecommendationReport:
    """Writes the result as CSV; an empty result replaces an older one."""
    tables = {n: read_table(spark, p, options.table_format) for n, p in paths.tables.items()}
    with Staging(spark) as staging:
        result, counts = recommend_with_report(tables, staging, options)
        if preview:
            result.show(10, truncate=False)
        write_text(result, paths.output)
        return RecommendationReport(**counts.first().asDict())


def side_by_side(spark: SparkSession, tasks: Mapping[str, Callable[[], Any]]) -> dict[str, Any]:
    """The results of independent tasks, which run at the same time in threads of their own; the
    cluster's scheduler shares the executors out. The first failure cancels the others' jobs and is
    raised once they have ended."""
    tag = f"shelfgap-{uuid.uuid4().hex}"
    context = spark.sparkContext
    stopped = threading.Event()

    def tagged(task: Callable[[], Any]) -> Any:
        context.addJobTag(tag)
        if stopped.is_set():
            return None
        return task()

    with ThreadPoolExecutor(max(1, len(tasks))) as pool:
        futures = {n: pool.submit(inheritable_thread_target(spark)(tagged), t) for n, t in tasks.items()}
        done, running = wait(futures.values(), return_when=FIRST_EXCEPTION)
        failed = next((f.exception() for f in done if f.exception()), None)
        if failed:
            stopped.set()
            while running:  # a thread between two jobs is met the next time
                context.cancelJobsWithTag(tag)
                running = wait(running, timeout=0.5)[1]
            raise failed
    return {name: future.result() for name, future in futures.items()}


def run_all(
    spark: SparkSession, config: JobConfig, preview: bool = False
) -> dict[str, IngestReport | RecommendationReport]:
    """The three ingests side by side, then the recommendations; the first failure ends the run.
    With a preview the ingests run in turn, so that their rows are not mixed."""
    tasks = {
        name: partial(ingest, spark, DATASETS[name], paths, config.options, preview)
        for name, paths in config.datasets.items()
    }
    reports: dict[str, IngestReport | RecommendationReport] = {}
    reports |= {n: task() for n, task in tasks.items()} if preview else side_by_side(spark, tasks)
    if config.result is not None:
        reports[RESULT_SECTION] = run_recommendation(
            spark, config.result, config.options, preview
        )
    return reports
