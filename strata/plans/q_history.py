"""Registered queries over stored state: sketches, key history, erasure; months are read once."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from strata.operators import asof, facts, ingest, lattice, privacy, silver
from strata.operators.quality import expectations as X
from strata.operators.quality.history import KeyHistory, key_types
from strata.ops import fingerprint, sketches
from strata.plans import erasure
from strata.plans import oracle as O
from strata.plans.graph import run_graph
from strata.plans.models import RunParams, TripModels
from strata.plans.monthly import Tables, land_months
from strata.plans.q_ingest import _scd_sql_ctes, zone_history
from strata.plans.q_ops import PROFILE_COLS, RUN_METADATA, _fingerprint_sql
from strata.plans.q_quality import BRONZE_DECIMALS, BRONZE_M, CHAIN_GATE, GOLD_RESULTS, GOLD_VERDICT, bronze_m
from strata.plans.registry import models, register
from strata.schemas import RAW_SCHEMA, SOURCE_TYPES
from strata.session import scratch_path
from strata.sinks.writers import clear_partitions, overwrite_partitions
from strata.sources import testbed
from strata.streaming.load import bronze_loader, ledger
from strata.streaming.pickup import ingest_available_now

BY_YEAR = "bronze_y AS (SELECT *, year(pickup_month) AS pickup_year FROM bronze_m)"
NUMBERS = [c for c, t in SOURCE_TYPES.items() if t.typeName() in ("decimal", "integer")]


def _kept(spark, state, name):
    """Store state rows by month and read them back: all that later queries see of the months."""
    path = scratch_path(spark, f"{name}-{uuid.uuid4().hex}")
    overwrite_partitions(state, path, "pickup_month")
    return spark.read.schema(state.schema).parquet(path).withColumn("pickup_year", F.year("pickup_month"))


def _profile_sql() -> str:
    def one(c):
        total = f"sum({c}::DECIMAL(28,6))::DECIMAL(38,6)" if c in NUMBERS else "NULL::DECIMAL(38,6)"
        return (
            f"SELECT pickup_year::INTEGER AS pickup_year, '{c}' AS column_name, count(*) AS rows, count(*) - count({c}) AS nulls, "
            f"min({c})::VARCHAR AS min_value, max({c})::VARCHAR AS max_value, {total} AS total FROM bronze_y GROUP BY pickup_year"
        )

    return "\nUNION ALL\n".join(map(one, PROFILE_COLS))


@register("sketch_profile", O.with_(O.CHAIN_BRONZE + [BRONZE_M, BY_YEAR], _profile_sql()))
def q_sketch_profile(spark, sf_dir):
    """Profile of every year from the stored rows of its months; the exact columns (for quantiles
    and distinct counts see ``sketch_errors``)."""
    state = _kept(spark, sketches.profile_state(bronze_m(spark, sf_dir), PROFILE_COLS, ["pickup_month"]), "profile-state")
    merged = sketches.merge_profile(state, ["pickup_year"])
    return merged.select("pickup_year", "column_name", "rows", "nulls", "min_value", "max_value", "total")


_SKETCHED = ("trip_distance", "fare_amount", "total_amount")


@register(
    "sketch_errors",
    O.with_(
        O.CHAIN_BRONZE + [BRONZE_M, BY_YEAR],
        "\nUNION ALL\n".join(
            f"SELECT pickup_year::INTEGER AS pickup_year, '{c}' AS column_name, m AS measure, count({c}) AS n_values, TRUE AS within_bound "
            f"FROM bronze_y, (VALUES ('p50'), ('p95'), ('p99'), ('distinct')) t(m) GROUP BY ALL"
            for c in _SKETCHED
        ),
    ),
)
def q_sketch_errors(spark, sf_dir):
    """Merged quantiles and distinct counts against exact ranks and counts of the rows, by year.

    within_bound: the asked rank lies within RANK_ERROR of the ranks that the estimate takes
    up in the data; the distinct count within DISTINCT_ERROR of the exact one.
    """
    rows = bronze_m(spark, sf_dir).withColumn("pickup_year", F.year("pickup_month")).select("pickup_month", "pickup_year", *_SKETCHED)
    state = _kept(spark, sketches.profile_state(rows, list(_SKETCHED), ["pickup_month"]), "profile-state")
    merged = sketches.merge_profile(state, ["pickup_year"])
    merged = merged.select("pickup_year", "column_name", "p50", "p95", "p99", "approx_distinct")
    long = rows.select("pickup_year", F.inline(F.array(*(F.struct(F.lit(c).alias("column_name"), F.col(c).cast("double").alias("x")) for c in _SKETCHED))))
    met = long.join(F.broadcast(merged), ["pickup_year", "column_name"])  # a row for each year and column
    names = [f"p{round(100 * q)}" for q in sketches.QUANTILES]
    counts = [f(F.col("x"), F.col(n)).alias(f"{n}_{side}") for n in names for side, f in (("lo", lambda x, v: F.count_if(x < v)), ("hi", lambda x, v: F.count_if(x <= v)))]
    exact = met.groupBy("pickup_year", "column_name").agg(
        F.count("x").alias("n"), F.count_distinct("x").alias("d"), F.first("approx_distinct").alias("approx"), *counts
    )
    off = F.lit(sketches.RANK_ERROR)

    def measured(name, ok):
        return F.struct(F.lit(name).alias("measure"), F.col("n").alias("n_values"), ok.alias("within_bound"))

    checks = [
        measured(n, (F.col(f"{n}_lo") / F.col("n") <= q + off) & (F.col(f"{n}_hi") / F.col("n") >= q - off))
        for n, q in zip(names, sketches.QUANTILES, strict=True)
    ]
    checks.append(measured("distinct", F.abs(F.col("approx") - F.col("d")) <= sketches.DISTINCT_ERROR * F.col("d") + 1))
    return exact.select("pickup_year", "column_name", F.inline(F.array(*checks)))


_CHECKED = "expectation_id, expectation_type, \"column\", element_count, unexpected_count, success"


@register(
    "gate_from_state",
    O.with_(
        O.CHAIN_BRONZE + [BRONZE_M, BY_YEAR, f"r AS ({O.suite_sql(X.TESTBED_BRONZE_SUITE, 'bronze_y', 'pickup_year', BRONZE_DECIMALS)})"],
        f"SELECT pickup_year::INTEGER AS pickup_year, {_CHECKED} FROM r",
    ),
)
def q_gate_from_state(spark, sf_dir):
    """The bronze suite of every year from the stored state rows of its months."""
    suite = X.TESTBED_BRONZE_SUITE
    state = _kept(spark, sketches.suite_state(bronze_m(spark, sf_dir), suite, ["pickup_month"]), "suite-state")
    merged = sketches.merge_suite(state, suite, ["pickup_year"])
    return merged.select("pickup_year", *(c.strip(' "') for c in _CHECKED.split(",")))


@register(
    "unique_against_history",
    O.with_(
        O.CHAIN_FCT,
        """bounds AS (SELECT min(pickup_month) AS oldest, max(pickup_month) AS newest FROM fct),
landed AS (
  SELECT trip_id FROM fct, bounds WHERE pickup_month = newest
  UNION ALL SELECT trip_id FROM fct, bounds WHERE pickup_month = oldest AND pu_location_id % 5 = 0
), new AS (SELECT trip_id, count(*) AS new_rows FROM landed GROUP BY trip_id),
old AS (
  SELECT trip_id, count(*) AS history_rows, count(DISTINCT pickup_month) AS months, min(pickup_month) AS first_month
  FROM fct, bounds WHERE pickup_month < newest GROUP BY trip_id
)
SELECT trip_id, new_rows, coalesce(history_rows, 0) AS history_rows, coalesce(months, 0) AS months, first_month
FROM new LEFT JOIN old USING (trip_id) WHERE history_rows IS NOT NULL OR new_rows > 1""",
    ),
)
def q_unique_against_history(spark, sf_dir):
    """Trip keys of the newest month, landed with rows of the oldest one again, against all stored months."""
    fct = models(spark, sf_dir).fct_trips.select("trip_id", "pickup_month", "pu_location_id")
    ends = fct.agg(F.min("pickup_month"), F.max("pickup_month")).first()
    oldest, newest = ends
    name = f"trip_keys_{uuid.uuid4().hex}"
    history = KeyHistory(spark, name, scratch_path(spark, name), key_types(fct, ["trip_id"]), buckets=8).open()
    history.store(fct.where(F.col("pickup_month") < F.lit(newest)), "pickup_month")
    again = fct.where((F.col("pickup_month") == F.lit(oldest)) & (F.col("pu_location_id") % 5 == 0))
    found = history.repeated(fct.where(F.col("pickup_month") == F.lit(newest)).unionByName(again), newest)
    # The found keys are stored while the table has its name, which goes then.
    at = scratch_path(spark, f"{name}-repeated")
    found.write.parquet(at)
    history.forget()
    return spark.read.schema(found.schema).parquet(at)


# -- erasure --------------------------------------------------------------------

_NEW_SALT = "strata-salt-v2"


def by_month(raw):
    """Landed rows with a month's together, a large month in several tasks: few files of bounded size."""
    return raw.withColumn("_m", F.trunc("tpep_pickup_datetime", "month")).hint("rebalance", "_m").drop("_m")


def stored_tables(m, tables):
    """The trip models of all months as the monthly run stores them, each table in one job.

    The landed rows are shuffled once, by month and before tokens widen them; the later tables are
    made from the stored ones, whose files hold a month each.
    """

    def stored(df, path):
        overwrite_partitions(df, path)
        return m.spark.read.schema(df.schema).parquet(path)

    at = m.p.transformed_at
    bronze = stored(ingest.with_pickup_month(TripModels(m.spark, by_month(m.raw), m.zone_seed, m.p).bronze), tables.bronze)
    lookup = privacy.build_pii_lookup(bronze).withColumn("pickup_month", F.trunc("tpep_pickup_datetime", "month"))
    stored(lookup.hint("rebalance", "pickup_month"), tables.pii_lookup)
    stg = stored(silver.stg_trips(bronze, at, m.months), tables.stg_trips)
    fct = stored(facts.fct_trips(stg, at), tables.fct_trips)
    stored(facts.fct_tokenization_audit(fct, at).hint("rebalance", "pickup_month"), tables.fct_tokenization_audit)
    erasure.write_filters(m.spark, tables)


@register(
    "targeted_erasure",
    O.with_(
        O.CHAIN_BRONZE,
        f"""months AS (
  SELECT pickup_month, row_number() OVER (ORDER BY pickup_month) AS i
  FROM (SELECT DISTINCT date_trunc('month', tpep_pickup_datetime)::DATE AS pickup_month FROM bronze_u)
), gone AS (
  SELECT VendorID, tpep_pickup_datetime FROM lookup
  JOIN months ON pickup_month = date_trunc('month', tpep_pickup_datetime)::DATE
  WHERE i IN (2, 5) AND passenger_id LIKE '7%'
), touched AS (SELECT DISTINCT date_trunc('month', tpep_pickup_datetime)::DATE AS pickup_month FROM gone),
kept AS (
  SELECT date_trunc('month', l.tpep_pickup_datetime)::DATE AS pickup_month, l.* FROM lookup l ANTI JOIN gone USING (VendorID, tpep_pickup_datetime)
), salted AS (
  SELECT k.*, sha256(passenger_id || CASE WHEN t.pickup_month IS NULL THEN '{O.P.salt}' ELSE '{_NEW_SALT}' END) AS tok
  FROM kept k LEFT JOIN touched t USING (pickup_month)
), lookups AS (SELECT pickup_month, count(*) AS lookup_rows FROM kept GROUP BY 1),
rows AS (
  SELECT date_trunc('month', b.tpep_pickup_datetime)::DATE AS pickup_month, count(*) AS bronze_rows, count(tok) AS with_tokens, min(tok) AS least_token
  FROM bronze_u b LEFT JOIN salted s USING (VendorID, tpep_pickup_datetime) GROUP BY 1
)
SELECT pickup_month, lookup_rows, bronze_rows, with_tokens AS bronze_tokens, with_tokens AS silver_tokens, with_tokens AS fact_tokens,
  least_token, CASE WHEN t.pickup_month IS NULL THEN 1 ELSE 2 END::INTEGER AS salt_version, t.pickup_month IS NOT NULL AS rewritten
FROM rows JOIN lookups USING (pickup_month) LEFT JOIN touched t USING (pickup_month)""",
    ),
)
def q_targeted_erasure(spark, sf_dir):
    """Subjects of two months erased from the stored tables of all months; what each month then holds.

    rewritten: whether the month's bronze files are others than before the erasure.
    """
    tables = Tables(scratch_path(spark, f"erasure-{uuid.uuid4().hex}"))
    stored_tables(models(spark, sf_dir), tables)
    lookup = spark.read.parquet(tables.pii_lookup)
    months = sorted(r[0] for r in lookup.select("pickup_month").distinct().collect())
    of = [m for i, m in enumerate(months, 1) if i in (2, 5)]
    gone = lookup.where(F.col("pickup_month").isin([F.lit(m) for m in of]) & F.col("passenger_id").startswith("7"))
    request = scratch_path(spark, f"erasure-request-{uuid.uuid4().hex}")
    gone.select("passenger_id").write.parquet(request)  # the request, as it would be handed in
    files = _files(spark, tables.bronze)
    stored = scratch_path(spark, f"erasure-files-{uuid.uuid4().hex}")
    files.write.parquet(stored)
    erasure.erase(spark, tables, "request-1", spark.read.parquet(request), _NEW_SALT, 2, O.P.transformed_at)

    now = _files(spark, tables.bronze).withColumn("here", F.lit(1))
    moved = spark.read.parquet(stored).join(now, ["pickup_month", "path"], "left").groupBy("pickup_month").agg(F.bool_or(F.col("here").isNull()).alias("rewritten"))

    def tokens(table, column):
        return spark.read.parquet(table).groupBy("pickup_month").agg(F.count("passenger_id_token").alias(column))

    bronze = spark.read.parquet(tables.bronze).groupBy("pickup_month").agg(
        F.count("*").alias("bronze_rows"), F.count("passenger_id_token").alias("bronze_tokens"),
        F.min("passenger_id_token").alias("least_token"), F.max("_salt_version").alias("salt_version"),
    )
    kept = spark.read.parquet(tables.pii_lookup).groupBy("pickup_month").agg(F.count("*").alias("lookup_rows"))
    for other in (kept, tokens(tables.stg_trips, "silver_tokens"), tokens(tables.fct_trips, "fact_tokens"), moved):
        bronze = bronze.join(other, "pickup_month")
    return bronze


def _files(spark, path):
    """(pickup_month, path) of a stored table's files."""
    at = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(path)
    name = F.col("_metadata.file_path")
    return at.select(F.to_date(F.regexp_extract(name, "pickup_month=([0-9-]+)", 1)).alias("pickup_month"), name.alias("path"))


# -- the whole run --------------------------------------------------------------

_EMPTY = "CAST([] AS VARCHAR[])"


def _step_sql(task, layer, table, rows_in, rows_out, where="ok", bad="0", suite="''", rate="1.0", failed=_EMPTY, status="'SUCCESS'"):
    return (
        f"SELECT pickup_month, '{task}' AS task_id, '{layer}' AS layer, '{table}' AS table_name, {rows_in}::BIGINT AS rows_in, "
        f"{rows_out}::BIGINT AS rows_out, {bad}::BIGINT AS rows_quarantined, {suite} AS ge_suite_name, {rate}::DOUBLE AS ge_pass_rate, "
        f"{failed} AS ge_failed_expectations, {status} AS status, TRUE AS measured FROM j WHERE {where}"
    )


@register(
    "run_graph",
    O.with_(
        CHAIN_GATE + O.CHAIN_FCT[len(O.CHAIN_BRONZE):] + [O.DAILY, GOLD_RESULTS, GOLD_VERDICT],
        """j AS (
  SELECT m.pickup_month, m.n, coalesce(b.success, FALSE) AS ok, b.pass_rate AS b_rate, b.failed_expectations AS b_failed,
    g.success AS g_ok, g.pass_rate AS g_rate, g.failed_expectations AS g_failed, d.days
  FROM (SELECT pickup_month, count(*) AS n FROM bronze_m GROUP BY 1) m
  JOIN (SELECT pickup_month, count(*) AS days FROM daily GROUP BY 1) d USING (pickup_month)
  LEFT JOIN bronze_verdict b USING (pickup_month) LEFT JOIN gold_verdict g USING (pickup_month)
)
"""
        + "\nUNION ALL\n".join([
            _step_sql("landing_to_bronze", "bronze", "bronze.trips", "n", "n", "TRUE"),
            _step_sql("ge_bronze", "bronze", "bronze.trips", "n", "CASE WHEN ok THEN n ELSE 0 END", "TRUE", "CASE WHEN ok THEN 0 ELSE n END",
                      "'bronze'", "b_rate", "b_failed", "CASE WHEN ok THEN 'SUCCESS' ELSE 'QUARANTINED' END"),
            _step_sql("silver", "silver", "silver.stg_trips", "n", "n"),
            _step_sql("gold", "gold", "gold.fct_trips", "n", "n"),
            _step_sql("serving", "gold", "gold.v_trips_summary", "days", "days"),
            _step_sql("ge_gold", "gold", "gold.fct_trips", "n", "n", suite="'gold'", rate="g_rate", failed="g_failed",
                      status="CASE WHEN g_ok THEN 'SUCCESS' ELSE 'FAILED' END"),
        ]),
    ),
)
def q_run_graph(spark, sf_dir):
    """Land every month, run all steps from landing to serving, and read the months' audit rows.

    measured: the row's times are those of a step that took time, in the order of the steps.
    """
    root = scratch_path(spark, f"graph-{uuid.uuid4().hex}")
    raw = testbed.trips_raw(spark, sf_dir)
    month = F.trunc("tpep_pickup_datetime", "month")
    land_months(by_month(raw), f"{root}/landing", month)
    landed = spark.read.parquet(f"{root}/landing").select("year", "month").distinct()
    months = [r[0] for r in landed.select(F.make_date(F.col("year").cast("int"), F.col("month").cast("int"), F.lit(1))).collect()]
    audit = run_graph(
        spark, Tables(f"{root}/tables"), f"{root}/landing", months, testbed.zone_seed(spark, sf_dir), RunParams(run_id="graph"),
        X.TESTBED_BRONZE_SUITE, X.TESTBED_GOLD_SUITE,
    )
    at = F.to_date(F.concat(F.regexp_extract("run_id", "-([0-9]{6})$", 1), F.lit("01")), "yyyyMMdd")
    timed = (F.col("finished_at") > F.col("started_at")) & (F.col("duration_sec") > 0)
    return audit.where("run_id LIKE 'graph-%'").select(
        at.alias("pickup_month"), "task_id", "layer", "table_name", "rows_in", "rows_out", "rows_quarantined", "ge_suite_name",
        "ge_pass_rate", "ge_failed_expectations", "status", timed.alias("measured"),
    )


# -- as-of join, incremental fingerprint, incremental load ----------------------------


@register(
    "scd2_as_of",
    O.with_(
        O.CHAIN_FCT + [O.ZONE] + _scd_sql_ctes(),
        """SELECT f.pickup_month, f.pu_location_id, h.valid_from AS dim_valid_from, h.zone_name AS dim_zone_name, COUNT(*) AS trips
FROM fct f LEFT JOIN h3 h ON f.pu_location_id = h.location_id AND f.pickup_at >= h.valid_from
  AND (h.valid_to IS NULL OR f.pickup_at < h.valid_to)
GROUP BY ALL""",
    ),
)
def q_scd2_as_of(spark, sf_dir):
    """Trips with the zone version valid at pickup, by the as-of scan (no broadcast), counted by month."""
    fct = models(spark, sf_dir).fct_trips.select("pickup_month", "pu_location_id", "pickup_at")
    j = asof.as_of(fct, zone_history(spark, sf_dir), "pu_location_id", "location_id", "pickup_at", ["zone_name"], 30 * asof.SLICE)
    return j.groupBy("pickup_month", "pu_location_id", F.col("valid_from").alias("dim_valid_from"), "dim_zone_name").agg(F.count("*").alias("trips"))


_CHANGED_MONTHS = """numbered AS (
  SELECT pickup_month, row_number() OVER (ORDER BY pickup_month) AS i FROM (SELECT DISTINCT pickup_month FROM bronze_all)
), bronze_m AS (
  SELECT b.* FROM bronze_all b JOIN numbered USING (pickup_month) WHERE i <> 3 AND (i <> 2 OR PULocationID % 2 = 1)
)"""


@register(
    "incremental_fingerprint",
    O.with_(O.CHAIN_BRONZE + [BRONZE_M.replace("bronze_m AS", "bronze_all AS"), _CHANGED_MONTHS], _fingerprint_sql()),
)
def q_incremental_fingerprint(spark, sf_dir):
    """Fingerprint of a table after a month was added, one replaced and one removed, from file rows."""
    bronze = bronze_m(spark, sf_dir).drop(*RUN_METADATA)
    path, state = (scratch_path(spark, f"{name}-{uuid.uuid4().hex}") for name in ("fingerprinted", "file-hashes"))
    months = sorted(r[0] for r in bronze.select("pickup_month").distinct().collect())
    m = models(spark, sf_dir)  # the landed rows are shuffled, not those that tokens have widened
    dealt = ingest.with_pickup_month(TripModels(spark, by_month(m.raw), m.zone_seed, m.p).bronze).drop(*RUN_METADATA)
    overwrite_partitions(dealt.where(F.col("pickup_month") != F.lit(months[0])), path)
    fingerprint.refresh(spark, path, state, "pickup_month", method="md5")
    odd = bronze.where((F.col("pickup_month") == F.lit(months[1])) & (F.col("PULocationID") % 2 == 1))
    overwrite_partitions(bronze.where(F.col("pickup_month") == F.lit(months[0])).unionByName(odd), path)
    clear_partitions(spark, path, "pickup_month", [months[2]])
    now, _ = fingerprint.refresh(spark, path, state, "pickup_month", method="md5")
    return fingerprint.table_fingerprint(now, "part").select(F.to_date("part").alias("pickup_month"), "rows", "content_hash")


@register(
    "stream_incremental_load",
    O.with_(
        O.CHAIN_BRONZE[:2],
        """SELECT CAST(date_trunc('month', tpep_pickup_datetime) AS DATE) AS pickup_month, COUNT(*) AS rows, COUNT(*) AS ledger_rows,
  CAST(SUM(total_amount) AS DECIMAL(20,2)) AS revenue, 2::BIGINT AS files
FROM bronze_u GROUP BY 1 HAVING COUNT(DISTINCT VendorID) = 2
UNION ALL SELECT CAST(date_trunc('month', tpep_pickup_datetime) AS DATE), COUNT(*), COUNT(*), CAST(SUM(total_amount) AS DECIMAL(20,2)), 1
FROM bronze_u GROUP BY 1 HAVING COUNT(DISTINCT VendorID) = 1""",
    ),
)
def q_stream_incremental_load(spark, sf_dir):
    """Months landed as a file for each vendor, loaded by a stream in several batches, then all of it once more."""
    run = scratch_path(spark, f"incremental-{uuid.uuid4().hex}")
    raw = testbed.trips_raw(spark, sf_dir)
    at = raw.withColumn("year", F.year("tpep_pickup_datetime")).withColumn("month", F.month("tpep_pickup_datetime"))
    for vendor in (1, 2):  # the second vendor's files come to months that are there
        mine = at.where(F.col("VendorID") == vendor).hint("rebalance", "year", "month")
        mine.write.mode("append").partitionBy("year", "month").parquet(f"{run}/landing")

    def to_bronze(batch):
        bronze = ingest.bronze_from_landing(batch.drop("year", "month"), "stream", F.col("_file"), "", "2024-02-01 02:00:00")
        return ingest.with_pickup_month(bronze)

    load = bronze_loader(f"{run}/bronze", f"{run}/ledger", to_bronze)
    schema = StructType([*RAW_SCHEMA.fields, StructField("year", IntegerType()), StructField("month", IntegerType())])
    named = lambda s: s.withColumn("_file", F.col("_metadata.file_path"))
    for checkpoint in ("first", "replay"):  # a lost checkpoint delivers every file again
        ingest_available_now(spark, f"{run}/landing", schema, f"{run}/{checkpoint}", load, named, max_files_per_trigger=90)
    bronze = spark.read.parquet(f"{run}/bronze").groupBy("pickup_month").agg(
        F.count("*").alias("rows"), F.sum("total_amount").cast("decimal(20,2)").alias("revenue")
    )
    on_record = ledger(spark, f"{run}/ledger").groupBy("pickup_month").agg(F.sum("rows").alias("ledger_rows"), F.count("*").alias("files"))
    return bronze.join(on_record, "pickup_month")


@register(
    "rejected_rows",
    O.with_(
        [O.RAW],
        """drifted AS (
  SELECT date_trunc('month', tpep_pickup_datetime)::DATE AS pickup_month,
    CASE WHEN passenger_count = 7 THEN 'n/a' END AS riders, CASE WHEN trip_distance >= 50 THEN trip_distance::VARCHAR || ' km' END AS miles
  FROM raw
)
SELECT pickup_month, count(*) AS landed, count(*) - count(coalesce(riders, miles)) AS loaded, count(coalesce(riders, miles)) AS rejected,
  count(riders) AS bad_passenger_count, count(miles) AS bad_trip_distance, sum(CASE WHEN riders IS NOT NULL AND miles IS NOT NULL THEN 1 ELSE 0 END)::BIGINT AS bad_both
FROM drifted GROUP BY pickup_month""",
    ),
)
def q_rejected_rows(spark, sf_dir):
    """Two numeric columns landed as text, some of it no numbers: rows loaded and rejected with reasons."""
    raw = testbed.trips_raw(spark, sf_dir)
    riders = F.when(F.col("passenger_count") == 7, "n/a").otherwise(F.col("passenger_count").cast("int").cast("string"))
    miles = F.when(F.col("trip_distance") >= 50, F.concat(F.col("trip_distance").cast("string"), F.lit(" km"))).otherwise(F.col("trip_distance").cast("string"))
    drifted = raw.withColumns({"passenger_count": riders, "trip_distance": miles})
    marked = lattice.with_rejects(drifted, SOURCE_TYPES).withColumn("pickup_month", F.trunc("tpep_pickup_datetime", "month"))
    why = F.col("_reject_reason")
    has = lambda c: F.coalesce(why.contains(f"{c}: "), F.lit(False))
    return marked.groupBy("pickup_month").agg(
        F.count("*").alias("landed"), F.count_if(why.isNull()).alias("loaded"), F.count(why).alias("rejected"),
        F.count_if(has("passenger_count")).alias("bad_passenger_count"), F.count_if(has("trip_distance")).alias("bad_trip_distance"),
        F.count_if(has("passenger_count") & has("trip_distance")).alias("bad_both"),
    )
