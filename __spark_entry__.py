"""Registered queries and their SQL counterparts.

Every query works on transactions derived from the whole ``orders`` and
``customer`` tables; ``testtables.py`` and the SQL below state the
same derivation.
"""

from __future__ import annotations

import os
import sys
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from ledgerlake import operators as op  # noqa: E402
from ledgerlake.contracts import (  # noqa: E402
    REQUIRED_COLUMNS,
    TRANSACTION_SCHEMA,
    TRANSACTION_TYPES,
)
from ledgerlake import plans  # noqa: E402
from ledgerlake.plans import MALFORMED, REASONS, ingest_layer, run_medallion  # noqa: E402
from ledgerlake.sources import (  # noqa: E402
    published_runs,
    read_layer,
    read_run,
    read_transactions_csv,
    scratch_path,
    write_layer,
)
from testtables import dirty_transactions, transactions, write_transactions_csv  # noqa: E402

try:  # an optional part of the library
    import corpus_pipeline
    from ledgerlake.llm import queries as llm_queries
except ImportError:
    corpus_pipeline = llm_queries = None

Query = Callable[[SparkSession, str], DataFrame]


def _silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.clean(transactions(spark, sf_dir))


def _stored(spark: SparkSession, df: DataFrame) -> DataFrame:
    """Store an input that is read more than once, as the pipeline does.

    Exchanges would be reused, but the wide de-duplication behind one would be
    finished again by every branch that reads it.
    """
    path = scratch_path(spark, "layer")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def type_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.type_metrics(_stored(spark, _silver(spark, sf_dir)), domain=TRANSACTION_TYPES)


def type_metrics_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metrics with a sketched median, and whether its rank is within the bound.

    The rank is off by no more than half a percent of the type's rows.
    """
    silver = _stored(spark, _silver(spark, sf_dir))
    return _median_checked(op.type_metrics(silver, "approx", TRANSACTION_TYPES), silver)


def _median_checked(metrics: DataFrame, silver: DataFrame) -> DataFrame:
    """The metrics, with whether the median's rank is within the bound instead of it."""
    own = F.broadcast(metrics.select(F.col("type").alias("of_type"), "median_amount_k"))
    # The metric is rounded to 10; half of that on either side counts as equal.
    off = F.col("amount") - F.col("median_amount_k") * 1000
    ranks = silver.join(own, F.col("type") == F.col("of_type")).groupBy("of_type").agg(
        F.avg((off < -5).cast("int")).alias("below"), F.avg((off > 5).cast("int")).alias("above")
    )
    within = (F.col("below") <= 0.505) & (F.col("above") <= 0.505)
    ranks = ranks.select("of_type", within.alias("median_within_bound"))
    joined = metrics.join(ranks, F.col("type") == F.col("of_type"))
    return joined.drop("of_type", "median_amount_k")


def medallion_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of each layer of a run that sets bad rows aside."""
    source = _write_dirty_csv(spark, sf_dir)
    run = run_medallion(spark, source, scratch_path(spark, "lake"), quarantine=True)
    reports = [
        read_layer(spark, layer.path).agg(
            F.lit(layer.layer).alias("layer"), F.count("*").alias("stored_rows")
        )
        for layer in (run.bronze, run.silver, run.silver.quarantined)
    ]
    return reports[0].unionByName(reports[1]).unionByName(reports[2])


def malformed_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Malformed lines counted while ingesting, against those found in storage."""
    path = scratch_path(spark, "bronze")
    run = ingest_layer(spark, _write_dirty_csv(spark, sf_dir), path, keep_malformed=True)
    return read_layer(spark, path).agg(
        F.lit(run.checks["malformed_lines"]).cast("bigint").alias("counted_lines"),
        F.count(MALFORMED).alias("stored_lines"),
    )


def lenient_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of a stored table, read together with files of another format."""
    rows = transactions(spark, sf_dir)
    good, broken = scratch_path(spark, "good"), scratch_path(spark, "broken")
    write_layer(rows, good)
    rows.write.csv(broken)
    found = read_layer(spark, [good, broken], rows.schema, skip_unreadable=True)
    return found.groupBy("type").agg(F.count("*").alias("readable_rows"))


def required_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells that are there in the columns which every step requires."""
    rows = op.assert_columns(transactions(spark, sf_dir))
    return rows.agg(*(F.count(c).alias(f"present_{c}") for c in REQUIRED_COLUMNS))


def invalid_type_emptiness(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether the report of invalid types is empty, before and after spoiling."""
    tables = {"clean": transactions(spark, sf_dir), "dirty": dirty_transactions(spark, sf_dir)}
    found = [
        op.invalid_type_report(df).agg(
            F.lit(name).alias("table_name"), (F.count("*") == 0).alias("is_empty")
        )
        for name, df in tables.items()
    ]
    return found[0].unionByName(found[1])


def _write_dirty_csv(spark: SparkSession, sf_dir: str) -> str:
    """Dirty transactions as CSV in which some amounts are not numbers."""
    path = scratch_path(spark, "csv")
    broken = F.when(F.col("txn_id") % 101 == 0, "n/a").otherwise(F.col("amount").cast("string"))
    rows = dirty_transactions(spark, sf_dir).withColumn("amount", broken)
    rows.select(*TRANSACTION_SCHEMA.names).write.option("header", True).csv(path)
    return path


def type_metrics_open_domain(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.type_metrics(_stored(spark, dirty_transactions(spark, sf_dir)))


def share_of_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = _silver(spark, sf_dir).groupBy("type").agg(F.count("*").alias("transaction_count"))
    return op.share_of_total(counts)


def median_by_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    silver = _stored(spark, _silver(spark, sf_dir))
    return op.median_by_key(silver, "type", "amount", TRANSACTION_TYPES)


def median_by_open_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.median_by_key(dirty_transactions(spark, sf_dir), "step", "amount")


def balance_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    flagged = op.flag_balance(transactions(spark, sf_dir))
    return flagged.select("txn_id", "type", "amount", "balance_check")


def balance_discrepancies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.balance_discrepancies(transactions(spark, sf_dir))


def silver_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _silver(spark, sf_dir)


def silver_flagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    flagged = op.clean(transactions(spark, sf_dir), keep_flags=True)
    return flagged.select("txn_id", "type", "amount", "balance_check")


def duplicate_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.duplicate_report(transactions(spark, sf_dir))


def invalid_type_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.invalid_type_report(dirty_transactions(spark, sf_dir))


def quarantine_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.quarantine_counts(dirty_transactions(spark, sf_dir))


def quarantined_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, quarantine = op.split_valid(dirty_transactions(spark, sf_dir))
    return quarantine.select("txn_id", "type", "amount")


def dq_suite(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.run_expectations(dirty_transactions(spark, sf_dir))


def balance_consistency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.balance_consistency(transactions(spark, sf_dir))


def distinct_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.distinct_types(transactions(spark, sf_dir))


def metric_sanity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.run_expectations(type_metrics(spark, sf_dir), op.METRIC_EXPECTATIONS)


def csv_ingest_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = write_transactions_csv(spark, sf_dir)
    return op.ingest_profile(read_transactions_csv(spark, path, strict_header=True))


def _stored_run(spark: SparkSession, sf_dir: str):
    source = write_transactions_csv(spark, sf_dir)
    return run_medallion(spark, source, scratch_path(spark, "lake"))


def layer_row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows counted while writing each layer against rows found in storage."""
    run = _stored_run(spark, sf_dir)
    reports = [
        read_layer(spark, layer.path).agg(
            F.lit(layer.layer).alias("layer"),
            F.lit(layer.rows).cast("bigint").alias("written_rows"),
            F.count("*").alias("stored_rows"),
        )
        for layer in (run.bronze, run.silver, run.gold)
    ]
    return reports[0].unionByName(reports[1]).unionByName(reports[2])


def medallion_end_to_end(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_layer(spark, _stored_run(spark, sf_dir).gold.path)


def _deliveries(spark: SparkSession, sf_dir: str, **options) -> str:
    """A lake with a run for each of two deliveries, which together are all transactions."""
    base = scratch_path(spark, "lake")
    for part, run_id in enumerate(("first", "second")):
        run_medallion(spark, write_transactions_csv(spark, sf_dir, part), base, run_id, **options)
    return base


def runs_of_a_lake(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The catalogue of two runs, against the rows that readers of each run find."""
    base = _deliveries(spark, sf_dir)
    listed = published_runs(spark, base).select("run_id", "layer", "newest", "rows")
    found = [
        read_run(spark, base, layer, run_id).agg(
            F.lit(run_id).alias("of_run"), F.lit(layer).alias("of_layer"), F.count("*").alias("found_rows")
        )
        for run_id in ("first", "second")
        for layer in ("bronze", "silver", "gold")
    ]
    rows = found[0]
    for more in found[1:]:
        rows = rows.unionByName(more)
    same = (F.col("run_id") == F.col("of_run")) & (F.col("layer") == F.col("of_layer"))
    return listed.join(rows, same, "full").drop("of_run", "of_layer")


def newest_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaned rows that a reader who names no run finds after two runs."""
    silver = read_run(spark, _deliveries(spark, sf_dir), "silver")
    return silver.groupBy("type").agg(F.count("*").alias("rows"), F.sum("step").alias("sum_step"))


def failed_gate_leaves_nothing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What readers find after a good run and one that its suite stops.

    The second run has the first one's id, so it would have replaced it.
    """
    base = scratch_path(spark, "lake")
    good = run_medallion(spark, write_transactions_csv(spark, sf_dir), base, "daily")
    try:
        run_medallion(
            spark, _write_dirty_csv(spark, sf_dir), base, "daily", quarantine=True,
            clean_gate=op.TRANSACTION_EXPECTATIONS,
        )
        failed = False
    except plans.ChecksFailed:
        failed = True
    silver = read_layer(spark, good.silver.target)
    return silver.groupBy(F.lit(failed).alias("second_failed"), "type").agg(F.count("*").alias("rows"))


def rows_by_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows in, set aside, dropped as copies and out per type, from the run's own counts."""
    base = scratch_path(spark, "lake")
    run_medallion(spark, _write_dirty_csv(spark, sf_dir), base, "daily", quarantine=True)
    return plans.rows_by_type(spark, base).drop("run_id")


def broken_expectations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transactions per set of expectations that they break; none broken for the good ones."""
    good, bad = op.split_by_expectations(dirty_transactions(spark, sf_dir))
    parts = op.broken_counts(bad).select(F.array_join("broken", ", ").alias("broken"), "rows")
    passing = good.agg(F.lit("").alias("broken"), F.count("*").alias("rows"))
    return parts.unionByName(passing)


def rows_with_broken_expectations(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, bad = op.split_by_expectations(dirty_transactions(spark, sf_dir))
    return bad.select("txn_id", "type", "amount", F.array_join("broken", ", ").alias("broken"))


def routed_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per layer of a run that sets aside whatever breaks the suite, with the reasons."""
    source = _write_dirty_csv(spark, sf_dir)
    run = run_medallion(
        spark, source, scratch_path(spark, "lake"), quarantine=True, route=op.TRANSACTION_EXPECTATIONS
    )
    aside = read_layer(spark, run.silver.quarantined.path)
    reasons = aside.groupBy(F.array_join(REASONS, ", ").alias("reasons")).agg(F.count("*").alias("rows"))
    others = [
        read_layer(spark, layer.path).agg(F.lit(layer.layer).alias("reasons"), F.count("*").alias("rows"))
        for layer in (run.bronze, run.silver)
    ]
    return reasons.unionByName(others[0]).unionByName(others[1])


def metrics_over_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metrics of two runs from their states, and whether their medians are within the bound."""
    base = _deliveries(spark, sf_dir, keep_states=True)
    metrics = plans.metrics_over_runs(spark, base)
    silver = read_run(spark, base, "silver", "first").unionByName(read_run(spark, base, "silver", "second"))
    return _median_checked(metrics, silver)


def rows_of_new_deliveries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaned rows per run where deliveries overlap: a part, all, and all once more."""
    base = scratch_path(spark, "lake")
    sources = {"part": write_transactions_csv(spark, sf_dir, 0), "all": write_transactions_csv(spark, sf_dir)}
    sources["again"] = sources["all"]
    for run_id, source in sources.items():
        run_medallion(spark, source, base, run_id, once=True)
    silver = [
        read_run(spark, base, "silver", run_id).agg(
            F.lit(run_id).alias("run_id"),
            F.count("*").alias("rows"),
            F.coalesce(F.sum("step"), F.lit(0)).alias("sum_step"),
        )
        for run_id in sources
    ]
    return silver[0].unionByName(silver[1]).unionByName(silver[2])


def known_rows_dropped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the dirty table that are not, as a whole, in the clean one."""
    dirty = _stored(spark, dirty_transactions(spark, sf_dir))
    known = op.digests(transactions(spark, sf_dir))
    return op.drop_known_rows(dirty, known, dirty.count()).select("txn_id", "type", "amount")


def metrics_of_arrivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metrics after three deliveries into one folder, each taken as a stream's batches.

    The last delivery brings the first one's rows once more.
    """
    folder, base, checkpoint = (scratch_path(spark, n) for n in ("in", "lake", "stream"))
    rows = transactions(spark, sf_dir).select("txn_id", *TRANSACTION_SCHEMA.fieldNames())
    rows = _stored(spark, rows)
    for part in (F.col("txn_id") % 2 == 0, F.col("txn_id") % 2 == 1, F.col("txn_id") % 2 == 0):
        rows.where(part).drop("txn_id").write.mode("append").option("header", True).csv(folder)
        plans.run_arrivals(spark, folder, base, checkpoint)
    runs = [r["run_id"] for r in published_runs(spark, base).select("run_id").distinct().collect()]
    silver = [read_run(spark, base, "silver", run_id) for run_id in runs]
    union = silver[0]
    for more in silver[1:]:
        union = union.unionByName(more)
    return _median_checked(plans.metrics_over_runs(spark, base), union)


def unexpected_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unexpected values of the dirty table that more than five rows have."""
    report = op.run_expectations(dirty_transactions(spark, sf_dir), examples=20)
    values = report.select("expectation", "column", "unexpected", F.inline("examples"))
    return values.where("rows > 5")


def csv_by_header_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two deliveries, one of them with its columns reversed and another one in between."""
    first, second = (scratch_path(spark, "csv") for _ in range(2))
    columns = TRANSACTION_SCHEMA.fieldNames()
    rows = transactions(spark, sf_dir)
    parts = [rows.where(F.col("txn_id") % 2 == part).select(*columns) for part in (0, 1)]
    parts[0].write.option("header", True).csv(first)
    turned = parts[1].select(*columns[:4:-1], F.lit("x").alias("branch"), *columns[4::-1])
    turned.write.option("header", True).csv(second)
    found = read_transactions_csv(spark, [first, second], by_name=True)
    return found.groupBy("type").agg(
        F.count("*").alias("rows"),
        *(F.count(c).alias(f"present_{c}") for c in columns if c != "type"),
        F.sum("step").alias("sum_step"),
        F.round(F.sum("amount"), 2).alias("sum_amount"),
    )


def entry(spark: SparkSession) -> DataFrame:
    """The flagship query: metrics per transaction type."""
    return type_metrics(spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Query]:
    registered = (
        type_metrics,
        type_metrics_sketch,
        type_metrics_open_domain,
        share_of_total,
        median_by_type,
        median_by_open_key,
        balance_flags,
        balance_discrepancies,
        silver_clean,
        silver_flagged,
        duplicate_report,
        invalid_type_report,
        quarantine_split,
        quarantined_rows,
        dq_suite,
        balance_consistency,
        distinct_types,
        metric_sanity,
        csv_ingest_profile,
        layer_row_counts,
        medallion_end_to_end,
        medallion_quarantine,
        malformed_lines,
        lenient_scan,
        required_columns,
        invalid_type_emptiness,
        runs_of_a_lake,
        newest_run,
        failed_gate_leaves_nothing,
        rows_by_type,
        broken_expectations,
        rows_with_broken_expectations,
        routed_quarantine,
        metrics_over_runs,
        rows_of_new_deliveries,
        known_rows_dropped,
        metrics_of_arrivals,
        unexpected_values,
        csv_by_header_name,
    )
    named = {query.__name__: query for query in registered}
    if llm_queries:
        named |= {"pipeline": corpus_pipeline.run} | llm_queries.queries()
    return named


# The derivation of the transactions. Columns in the contract's order.
_TXN = """
WITH base AS (
  SELECT o_orderkey AS txn_id,
         CAST(o_orderkey % 744 + 1 AS INTEGER) AS step,
         CASE o_orderpriority WHEN '1-URGENT' THEN 'TRANSFER' WHEN '2-HIGH' THEN 'CASH_OUT'
              WHEN '3-MEDIUM' THEN 'PAYMENT' WHEN '4-NOT SPECIFIED' THEN 'CASH_IN'
              WHEN '5-LOW' THEN 'DEBIT' END AS type,
         CASE WHEN o_orderkey % 53 = 0 THEN NULL ELSE o_totalprice END AS amount,
         'C' || o_custkey AS nameOrig,
         CASE WHEN o_custkey % 10 = 0 THEN CAST(0 AS DOUBLE)
              ELSE o_totalprice + abs(c_acctbal) END AS oldbalanceOrg,
         CASE WHEN o_custkey % 10 = 0 THEN CAST(0 AS DOUBLE)
              ELSE o_totalprice + abs(c_acctbal)
                   - o_totalprice * (1 + (o_orderkey % 5) * CAST(0.0085 AS DOUBLE)) END AS newbalanceOrig,
         (CASE WHEN o_orderpriority = '3-MEDIUM' THEN 'M' ELSE 'C' END) || (o_orderkey % 1000) AS nameDest,
         CASE WHEN o_orderkey % 59 = 0 THEN NULL ELSE abs(c_acctbal) END AS oldbalanceDest,
         CASE WHEN o_orderkey % 59 = 0 THEN NULL ELSE abs(c_acctbal) + o_totalprice END AS newbalanceDest,
         CASE WHEN o_orderkey % 775 = 0 THEN 1 ELSE 0 END AS isFraud,
         CASE WHEN o_totalprice > 490000 AND o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END AS isFlaggedFraud
  FROM orders JOIN customer ON o_custkey = c_custkey
), txn AS (
  SELECT * FROM base
  UNION ALL SELECT * FROM base WHERE txn_id % 97 = 0
  UNION ALL SELECT * REPLACE (CAST(0 AS DOUBLE) AS amount) FROM base WHERE txn_id % 106 = 0
)"""

_DIRTY = (
    _TXN
    + """, dirty AS (
  SELECT * REPLACE (
    CASE WHEN txn_id % 211 = 0 THEN NULL WHEN txn_id % 199 = 0 THEN 'REFUND'
         WHEN txn_id % 197 = 0 THEN 'cash-in' ELSE type END AS type,
    CASE WHEN txn_id % 193 = 0 THEN -amount ELSE amount END AS amount)
  FROM txn
)"""
)

_BROKEN = (
    _DIRTY
    + """, broken AS (
  SELECT *, txn_id % 101 = 0 OR coalesce(type NOT IN
         ('PAYMENT', 'TRANSFER', 'CASH_OUT', 'CASH_IN', 'DEBIT'), false) AS apart
  FROM dirty
)"""
)

# Why a row of the dirty table breaks the suite, in the suite's order.
_REASONS = """concat_ws(', ',
         CASE WHEN type IS NULL THEN 'type not_null' END,
         CASE WHEN type NOT IN ('PAYMENT', 'TRANSFER', 'CASH_OUT', 'CASH_IN', 'DEBIT') THEN 'type in_set' END,
         CASE WHEN amount IS NULL THEN 'amount not_null' END,
         CASE WHEN amount <= 0 THEN 'amount between' END)"""

_SILVER = (
    _TXN
    + """, silver AS (
  SELECT txn_id, step, type, coalesce(amount, 0) AS amount, nameOrig,
         coalesce(oldbalanceOrg, 0) AS oldbalanceOrg, coalesce(newbalanceOrig, 0) AS newbalanceOrig,
         nameDest, oldbalanceDest, newbalanceDest, isFraud, isFlaggedFraud
  FROM (SELECT DISTINCT * FROM txn)
)"""
)



def _metrics_of(table: str) -> str:
    return f""", metrics AS (
  SELECT type,
         count(*) AS transaction_count,
         round(avg(amount / 1000), 2) AS avg_amount_k,
         round(sum(amount) / 1000000, 3) AS total_volume_m,
         round(quantile_disc(amount, 0.5) / 1000, 2) AS median_amount_k,
         round(avg((newbalanceOrig - oldbalanceOrg)
               / (CASE WHEN oldbalanceOrg <> 0 THEN oldbalanceOrg ELSE 1 END) * 100), 2)
           AS avg_balance_change_pct,
         count(*) FILTER (WHERE oldbalanceOrg = 0) AS zero_balance_count,
         round(sum(amount) / nullif(sum(oldbalanceOrg), 0), 4) AS volume_to_balance_ratio,
         round(avg(CASE WHEN amount > 10000 THEN 1 ELSE 0 END) * 100, 2) AS large_txn_ratio_pct,
         round(count(*) / sum(count(*)) OVER () * 100, 2) AS percentage_of_total
  FROM {table} GROUP BY type
)"""


_METRICS = _SILVER + _metrics_of("silver")

_DOMAIN = "('PAYMENT', 'TRANSFER', 'CASH_OUT', 'CASH_IN', 'DEBIT')"
_DRIFT = "abs(oldbalanceOrg - amount - newbalanceOrig)"
_LABEL = f"""CASE
    WHEN type = 'PAYMENT' AND {_DRIFT} > amount * CAST(0.01 AS DOUBLE) THEN 'payment_fee_exceeded'
    WHEN type = 'TRANSFER' AND {_DRIFT} > amount * CAST(0.02 AS DOUBLE) THEN 'transfer_fee_exceeded'
    WHEN type = 'CASH_OUT' AND {_DRIFT} > amount * CAST(0.03 AS DOUBLE) THEN 'cashout_fee_exceeded'
    ELSE 'valid' END"""


def _expectation_sql(name: str, column: str, evaluated: str, unexpected: str, table: str) -> str:
    return f"""SELECT '{name}' AS expectation, '{column}' AS "column",
  count({evaluated}) AS evaluated,
  count(*) FILTER (WHERE {unexpected}) AS unexpected,
  count(*) FILTER (WHERE {unexpected}) = 0 AS success
FROM {table}"""


def oracle_sql() -> dict[str, str]:
    metrics = _METRICS + " SELECT * FROM metrics"
    dirty_checks = (
        ("not_null", "type", "*", "type IS NULL", "dirty"),
        ("in_set", "type", "type", f"type NOT IN {_DOMAIN}", "dirty"),
        ("not_null", "amount", "*", "amount IS NULL", "dirty"),
        ("between", "amount", "amount", "amount <= 0", "dirty"),
    )
    share = "percentage_of_total"
    metric_checks = (
        ("between", "transaction_count", "transaction_count", "transaction_count <= 0", "metrics"),
        ("between", share, share, f"{share} <= 0 OR {share} > 100", "metrics"),
        ("between", "avg_amount_k", "avg_amount_k", "avg_amount_k <= 0", "metrics"),
    )
    contract = (
        "step type amount nameOrig oldbalanceOrg newbalanceOrig nameDest "
        "oldbalanceDest newbalanceDest isFraud isFlaggedFraud"
    ).split()
    present = ", ".join(f'count({c}) AS "present_{c}"' for c in contract if c != "type")
    null_counts = ", ".join(f"count(*) FILTER (WHERE {c} IS NULL) AS null_{c}" for c in contract)
    llm = llm_queries.oracle_sql() if llm_queries else {}
    if llm_queries and corpus_pipeline.ORACLE_SQL:
        llm["pipeline"] = corpus_pipeline.ORACLE_SQL
    return llm | {
        "type_metrics": metrics,
        "type_metrics_sketch": _METRICS
        + " SELECT * EXCLUDE (median_amount_k), true AS median_within_bound FROM metrics",
        "type_metrics_open_domain": _DIRTY + _metrics_of("dirty") + " SELECT * FROM metrics",
        "share_of_total": _METRICS + " SELECT type, transaction_count, percentage_of_total FROM metrics",
        "median_by_type": _SILVER
        + " SELECT type, quantile_disc(amount, 0.5) AS median FROM silver GROUP BY type",
        "median_by_open_key": _DIRTY
        + """ SELECT step, quantile_disc(amount, 0.5) AS median FROM dirty
              WHERE amount IS NOT NULL GROUP BY step""",
        "balance_flags": _TXN + f" SELECT txn_id, type, amount, {_LABEL} AS balance_check FROM txn",
        "balance_discrepancies": _TXN
        + f""" SELECT type, balance_check, count(*) AS count
               FROM (SELECT type, {_LABEL} AS balance_check FROM txn)
               WHERE balance_check <> 'valid' GROUP BY type, balance_check""",
        "silver_clean": _SILVER + " SELECT * FROM silver",
        "silver_flagged": _TXN
        + f""" SELECT txn_id, type, coalesce(amount, 0) AS amount, {_LABEL} AS balance_check
               FROM (SELECT DISTINCT * FROM txn)""",
        "duplicate_report": _TXN
        + """ SELECT total_rows, distinct_rows, total_rows - distinct_rows AS duplicate_rows
              FROM (SELECT count(*) AS total_rows FROM txn),
                   (SELECT count(*) AS distinct_rows FROM (SELECT DISTINCT * FROM txn))""",
        "invalid_type_report": _DIRTY
        + f" SELECT type, count(*) AS count FROM dirty WHERE type NOT IN {_DOMAIN} GROUP BY type",
        "quarantine_split": _DIRTY
        + f""" SELECT count(*) AS total_rows,
                      count(*) FILTER (WHERE type IS NULL OR type IN {_DOMAIN}) AS passing_rows,
                      count(*) FILTER (WHERE type NOT IN {_DOMAIN}) AS quarantined_rows
               FROM dirty""",
        "quarantined_rows": _DIRTY
        + f" SELECT txn_id, type, amount FROM dirty WHERE type NOT IN {_DOMAIN}",
        "dq_suite": _DIRTY + " UNION ALL ".join(f" {_expectation_sql(*c)}" for c in dirty_checks),
        "balance_consistency": _TXN
        + f""" SELECT count(*) AS evaluated,
                      count(*) FILTER (WHERE NOT coalesce({_DRIFT} < CAST(0.01 AS DOUBLE), false)) AS unexpected,
                      count(*) FILTER (WHERE NOT coalesce({_DRIFT} < CAST(0.01 AS DOUBLE), false)) = 0 AS success
               FROM txn WHERE type = 'PAYMENT'""",
        "distinct_types": _TXN + " SELECT DISTINCT type FROM txn",
        "metric_sanity": _METRICS + " UNION ALL ".join(f" {_expectation_sql(*c)}" for c in metric_checks),
        "csv_ingest_profile": _TXN + f" SELECT count(*) AS total_rows, {null_counts} FROM txn",
        "layer_row_counts": _METRICS
        + """ SELECT layer, n AS written_rows, n AS stored_rows FROM (
                SELECT 'bronze' AS layer, count(*) AS n FROM txn
                UNION ALL SELECT 'silver', count(*) FROM silver
                UNION ALL SELECT 'gold', count(*) FROM metrics)""",
        "medallion_end_to_end": metrics,
        "medallion_quarantine": _BROKEN
        + """, good AS (SELECT DISTINCT * EXCLUDE (txn_id) FROM broken WHERE NOT apart)
             SELECT 'bronze' AS layer, count(*) AS stored_rows FROM broken
             UNION ALL SELECT 'silver', count(*) FROM good
             UNION ALL SELECT 'quarantine', count(*) FROM broken WHERE apart""",
        "lenient_scan": _TXN + " SELECT type, count(*) AS readable_rows FROM txn GROUP BY type",
        "required_columns": _TXN
        + """ SELECT count(type) AS present_type, count(amount) AS present_amount,
                     count(oldbalanceOrg) AS "present_oldbalanceOrg",
                     count(newbalanceOrig) AS "present_newbalanceOrig" FROM txn""",
        "invalid_type_emptiness": _DIRTY
        + f""" SELECT 'clean' AS table_name, count(*) FILTER (WHERE type NOT IN {_DOMAIN}) = 0 AS is_empty FROM txn
               UNION ALL SELECT 'dirty', count(*) FILTER (WHERE type NOT IN {_DOMAIN}) = 0 FROM dirty""",
        "runs_of_a_lake": _METRICS
        + """, rows_of AS (
               SELECT txn_id % 2 AS part, 'bronze' AS layer, count(*) AS n FROM txn GROUP BY 1
               UNION ALL SELECT txn_id % 2, 'silver', count(*) FROM silver GROUP BY 1
               UNION ALL SELECT txn_id % 2, 'gold', count(DISTINCT type) FROM silver GROUP BY 1)
             SELECT CASE part WHEN 0 THEN 'first' ELSE 'second' END AS run_id, layer,
                    part = 1 AS newest, n AS "rows", n AS found_rows FROM rows_of""",
        "newest_run": _SILVER
        + """ SELECT type, count(*) AS "rows", CAST(sum(step) AS BIGINT) AS sum_step
              FROM silver WHERE txn_id % 2 = 1 GROUP BY type""",
        "failed_gate_leaves_nothing": _SILVER
        + ' SELECT true AS second_failed, type, count(*) AS "rows" FROM silver GROUP BY type',
        "rows_by_type": _BROKEN
        + f""", named AS (
               SELECT *, CASE WHEN type IS NULL THEN '(null)' WHEN type IN {_DOMAIN} THEN type
                              ELSE '(other)' END AS kind,
                      CASE WHEN txn_id % 101 = 0 THEN NULL ELSE amount END AS read_amount FROM broken
             ), counted AS (
               SELECT kind, count(*) AS rows_in, count(*) FILTER (WHERE apart) AS quarantined FROM named GROUP BY kind
             ), kept AS (
               SELECT kind, count(*) AS rows_out FROM (
                 SELECT DISTINCT * EXCLUDE (txn_id, amount) FROM named WHERE NOT apart) GROUP BY kind)
             SELECT kind AS type, rows_in, quarantined, rows_in - quarantined - coalesce(rows_out, 0) AS duplicates,
                    coalesce(rows_out, 0) AS rows_out FROM counted LEFT JOIN kept USING (kind)""",
        "broken_expectations": _DIRTY
        + f' SELECT {_REASONS} AS broken, count(*) AS "rows" FROM dirty GROUP BY 1',
        "rows_with_broken_expectations": _DIRTY
        + f""" SELECT * FROM (SELECT txn_id, type, amount, {_REASONS} AS broken FROM dirty)
               WHERE broken <> ''""",
        "routed_quarantine": _DIRTY
        + f""", seen AS (
               SELECT * REPLACE (CASE WHEN txn_id % 101 = 0 THEN NULL ELSE amount END AS amount) FROM dirty
             ), flagged AS (
               SELECT *, concat_ws(', ', CASE WHEN type NOT IN {_DOMAIN} THEN 'invalid type' END,
                                   CASE WHEN txn_id % 101 = 0 THEN 'malformed line' END,
                                   nullif({_REASONS}, '')) AS reasons FROM seen
             ), good AS (SELECT DISTINCT * EXCLUDE (txn_id) FROM flagged WHERE reasons = '')
             SELECT reasons, count(*) AS "rows" FROM flagged WHERE reasons <> '' GROUP BY reasons
             UNION ALL SELECT 'bronze', count(*) FROM flagged
             UNION ALL SELECT 'silver', count(*) FROM good""",
        "metrics_over_runs": _METRICS
        + " SELECT * EXCLUDE (median_amount_k), true AS median_within_bound FROM metrics",
        "metrics_of_arrivals": _METRICS
        + " SELECT * EXCLUDE (median_amount_k), true AS median_within_bound FROM metrics",
        "csv_by_header_name": _TXN
        + f""" SELECT type, count(*) AS "rows", {present}, CAST(sum(step) AS BIGINT) AS sum_step,
                      round(sum(amount), 2) AS sum_amount FROM txn GROUP BY type""",
        "unexpected_values": _DIRTY
        + f""", bad AS (
               SELECT 'in_set' AS expectation, 'type' AS "column", type AS value FROM dirty
               WHERE type NOT IN {_DOMAIN}
               UNION ALL SELECT 'between', 'amount', CAST(amount AS VARCHAR) FROM dirty WHERE amount <= 0)
             SELECT expectation, "column", sum(n) OVER (PARTITION BY expectation)::BIGINT AS unexpected,
                    value, n AS "rows"
             FROM (SELECT expectation, "column", value, count(*) AS n FROM bad GROUP BY ALL)
             QUALIFY n > 5""",
        "rows_of_new_deliveries": _SILVER
        + """ SELECT run_id, count(txn_id) AS "rows", CAST(coalesce(sum(step), 0) AS BIGINT) AS sum_step
              FROM (VALUES ('part', 0), ('all', 1), ('again', 2)) runs(run_id, part)
              LEFT JOIN silver ON silver.txn_id % 2 = part GROUP BY run_id""",
        "known_rows_dropped": _DIRTY
        + """, new AS (SELECT * FROM dirty EXCEPT SELECT * FROM txn)
             SELECT txn_id, type, amount FROM dirty d WHERE EXISTS (
               SELECT 1 FROM new n WHERE n.txn_id = d.txn_id AND n.type IS NOT DISTINCT FROM d.type
                 AND n.amount IS NOT DISTINCT FROM d.amount)""",
        "malformed_lines": _BROKEN
        + """ SELECT count(*) FILTER (WHERE txn_id % 101 = 0) AS counted_lines,
                     count(*) FILTER (WHERE txn_id % 101 = 0) AS stored_lines FROM broken""",
    }
