"""DuckDB statements that recompute registered queries independently.

These are test oracles, kept next to the models they mirror. Each statement reads
the pre-registered test tables only. Type conventions (see the README): decimal sums
are cast to DECIMAL(20,2); decimal means are computed exactly in integer arithmetic
with HALF_UP rounding, as Spark does, instead of DuckDB's DOUBLE mean.
"""

from __future__ import annotations

from strata.plans.models import RunParams

P = RunParams()

# Fixed value: the surrogate-key NULL marker (same as strata.functions.keys).
SK_NULL = "_dbt_utils_surrogate_key_null_"


def sk(*cols: str) -> str:
    parts = ", ".join(f"coalesce(CAST({c} AS VARCHAR), '{SK_NULL}')" for c in cols)
    return f"md5(concat_ws('-', {parts}))"


def avg_dec(expr: str, scale_in: int = 2, prec_in: int = 10) -> str:
    """Exact mean of a DECIMAL(prec_in, scale_in) column as Spark types it:
    DECIMAL(prec_in+4, scale_in+4), rounded HALF_UP (away from zero on ties)."""
    s = f"SUM(CAST(({expr}) * {10 ** scale_in} AS HUGEINT))"
    n = f"COUNT({expr})"
    q = (
        f"(CASE WHEN {s} >= 0 THEN ({s} * 20000 + {n}) // (2 * {n}) "
        f"ELSE -((-{s} * 20000 + {n}) // (2 * {n})) END)"
    )
    so = scale_in + 4
    unit = "0." + "0" * (so - 1) + "1"
    return (
        f"(CASE WHEN {n} = 0 THEN NULL ELSE CAST(CAST({q} AS DECIMAL(38,0)) * CAST({unit} AS DECIMAL({so + 1},{so})) "
        f"AS DECIMAL({prec_in + 4},{so})) END)"
    )


def cents(column: str) -> str:
    """Exact integer sum of a DECIMAL(10,2) column, in hundredths; NULL if it has no value."""
    return f"SUM(CAST({column} * 100 AS HUGEINT))"


def from_cents(total: str) -> str:
    """A sum of hundredths as DECIMAL(20,2)."""
    return f"CAST(CAST({total} AS DECIMAL(28,0)) * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(20,2))"


def mean_of_cents(total: str, n: str) -> str:
    """Mean of ``n`` values from their sum in hundredths: six decimals, rounded HALF_UP."""
    up = f"(abs({total}) * 20000 + {n}) // (2 * {n})"
    return f"CASE WHEN {n} > 0 THEN CAST(CAST(sign({total}) * {up} AS DECIMAL(28,0)) * CAST(0.000001 AS DECIMAL(7,6)) AS DECIMAL(14,6)) END"


def dsum(expr: str, prec: int = 20) -> str:
    """SUM of DECIMAL(prec-10, s) as Spark types it: DECIMAL(prec, s) (s = 2 by default)."""
    return f"CAST(SUM({expr}) AS DECIMAL({prec},2))"


def ts(value: str) -> str:
    return f"TIMESTAMP '{value}'"


MONEY_COLS = [
    "fare_amount", "extra", "mta_tax", "tip_amount", "tolls_amount",
    "improvement_surcharge", "total_amount", "congestion_surcharge", "airport_fee",
]

RAW = """raw AS (
  SELECT
    CAST(l.l_linenumber % 2 + 1 AS BIGINT) AS VendorID,
    CAST(o.o_orderdate AS TIMESTAMP) AS tpep_pickup_datetime,
    CAST(l.l_shipdate AS TIMESTAMP) AS tpep_dropoff_datetime,
    CAST(l.l_linenumber AS DOUBLE) AS passenger_count,
    l.l_quantity AS trip_distance,
    CAST(l.l_linenumber AS DOUBLE) AS RatecodeID,
    l.l_returnflag AS store_and_fwd_flag,
    CAST(s.s_nationkey + 1 AS BIGINT) AS PULocationID,
    CAST(c.c_nationkey + 1 AS BIGINT) AS DOLocationID,
    CAST(substr(o.o_orderpriority, 1, 1) AS BIGINT) - 1 AS payment_type,
    CAST(CAST(l.l_extendedprice AS DECIMAL(12,2)) AS DOUBLE) AS fare_amount,
    CAST(0.0 AS DOUBLE) AS extra,
    CAST(round(CAST(l.l_extendedprice AS DECIMAL(12,2)) * CAST(l.l_tax AS DECIMAL(4,2)), 2) AS DOUBLE) AS mta_tax,
    CAST(round(CAST(l.l_extendedprice AS DECIMAL(12,2)) * CAST(l.l_discount AS DECIMAL(4,2)), 2) AS DOUBLE) AS tip_amount,
    CAST(0.0 AS DOUBLE) AS tolls_amount,
    CAST(0.0 AS DOUBLE) AS improvement_surcharge,
    CAST(CAST(l.l_extendedprice AS DECIMAL(12,2))
      + round(CAST(l.l_extendedprice AS DECIMAL(12,2)) * CAST(l.l_discount AS DECIMAL(4,2)), 2)
      + round(CAST(l.l_extendedprice AS DECIMAL(12,2)) * CAST(l.l_tax AS DECIMAL(4,2)), 2) AS DOUBLE) AS total_amount,
    CAST(CASE WHEN year(o.o_orderdate) >= 1997 THEN 2.5 END AS DOUBLE) AS congestion_surcharge,
    CAST(CASE WHEN year(o.o_orderdate) >= 1999 THEN 1.25 END AS DOUBLE) AS airport_fee
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN supplier s ON l.l_suppkey = s.s_suppkey
)"""

_money_casts = ",\n    ".join(f"CAST({c} AS DECIMAL(10,2)) AS {c}" for c in MONEY_COLS)
BRONZE_U = f"""bronze_u AS (
  SELECT
    CAST(VendorID AS INTEGER) AS VendorID,
    tpep_pickup_datetime,
    tpep_dropoff_datetime,
    CAST(trunc(passenger_count) AS INTEGER) AS passenger_count,
    CAST(trip_distance AS DECIMAL(10,2)) AS trip_distance,
    CAST(trunc(RatecodeID) AS INTEGER) AS RatecodeID,
    store_and_fwd_flag,
    CAST(PULocationID AS INTEGER) AS PULocationID,
    CAST(DOLocationID AS INTEGER) AS DOLocationID,
    CAST(payment_type AS INTEGER) AS payment_type,
    {_money_casts},
    '{P.run_id}' AS _run_id,
    '{P.source_url}' AS _source_url,
    '{P.source_sha256}' AS _source_sha256,
    {ts(P.ingested_at)} AS _ingested_at,
    CAST({P.schema_version} AS INTEGER) AS _schema_version
  FROM raw
)"""

SEED = "(coalesce(CAST(VendorID AS VARCHAR), 'None') || '|' || coalesce(CAST(tpep_pickup_datetime AS VARCHAR), 'None'))"


def _digits(h: str, n: int) -> str:
    return f"rpad(substr(regexp_replace({h}, '[^0-9]', '', 'g'), 1, {n}), {n}, '0')"


LOOKUP = f"""pii_keys AS (
  SELECT DISTINCT VendorID, tpep_pickup_datetime FROM bronze_u
),
lookup AS (
  SELECT
    VendorID,
    tpep_pickup_datetime,
    'user_' || substr(md5({SEED}), 1, 8) || '@example.com' AS passenger_email,
    substr({_digits("md5('phone' || " + SEED + ")", 10)}, 1, 3) || '-' ||
      substr({_digits("md5('phone' || " + SEED + ")", 10)}, 4, 3) || '-' ||
      substr({_digits("md5('phone' || " + SEED + ")", 10)}, 7, 4) AS passenger_phone,
    {_digits("md5('card' || " + SEED + ")", 4)} AS payment_card_last4,
    md5('pid' || {SEED}) AS passenger_id
  FROM pii_keys
)"""


def tokens_cte(name: str = "tokens", salt: str = P.salt, lookup: str = "lookup") -> str:
    return f"""{name} AS (
  SELECT VendorID, tpep_pickup_datetime,
    sha256(passenger_email || '{salt}') AS passenger_email_token,
    sha256(passenger_phone || '{salt}') AS passenger_phone_token,
    sha256(payment_card_last4 || '{salt}') AS payment_card_last4_token,
    sha256(passenger_id || '{salt}') AS passenger_id_token
  FROM {lookup}
)"""


def bronze_cte(name: str = "bronze", tokens: str = "tokens", version: int = P.salt_version) -> str:
    return f"""{name} AS (
  SELECT b.*, t.passenger_email_token, t.passenger_phone_token, t.payment_card_last4_token,
         t.passenger_id_token, CAST({version} AS INTEGER) AS _salt_version
  FROM bronze_u b LEFT JOIN {tokens} t
    ON b.VendorID = t.VendorID AND b.tpep_pickup_datetime = t.tpep_pickup_datetime
)"""


STG = f"""stg AS (
  SELECT
    VendorID AS vendor_id,
    tpep_pickup_datetime AS pickup_at,
    tpep_dropoff_datetime AS dropoff_at,
    CAST(date_trunc('month', tpep_pickup_datetime) AS DATE) AS pickup_month,
    passenger_count, trip_distance,
    RatecodeID AS rate_code_id,
    store_and_fwd_flag,
    PULocationID AS pu_location_id,
    DOLocationID AS do_location_id,
    payment_type, fare_amount, extra, mta_tax, tip_amount, tolls_amount,
    improvement_surcharge, total_amount,
    coalesce(congestion_surcharge, CAST(0 AS DECIMAL(10,2))) AS congestion_surcharge,
    coalesce(airport_fee, CAST(0 AS DECIMAL(10,2))) AS airport_fee,
    passenger_email_token, passenger_phone_token, payment_card_last4_token, passenger_id_token,
    _salt_version, _ingested_at, _source_url, _source_sha256, _schema_version,
    {ts(P.transformed_at)} AS _transformed_at
  FROM bronze
)"""

TRIP_KEY = ["vendor_id", "pickup_at", "dropoff_at", "pu_location_id", "do_location_id",
            "fare_amount", "total_amount", "trip_distance", "passenger_count"]

FCT = f"""fct AS (
  SELECT
    {sk(*TRIP_KEY)} AS trip_id,
    vendor_id, pickup_at, dropoff_at, pickup_month,
    CAST(date_diff('second', pickup_at, dropoff_at) / 60.0 AS DECIMAL(10,2)) AS duration_min,
    passenger_count, trip_distance, rate_code_id, pu_location_id, do_location_id, payment_type,
    fare_amount, extra, mta_tax, tip_amount, tolls_amount, improvement_surcharge,
    congestion_surcharge, airport_fee, total_amount,
    CASE WHEN fare_amount > 0 THEN CAST(tip_amount / fare_amount * 100.0 AS DECIMAL(10,2)) END AS tip_pct,
    passenger_email_token, passenger_phone_token, payment_card_last4_token, passenger_id_token,
    _salt_version, _ingested_at, _source_url,
    {ts(P.transformed_at)} AS _transformed_at
  FROM stg
)"""

ZONE = f"""zone_seed AS (
  SELECT CAST(n.n_nationkey + 1 AS INTEGER) AS LocationID, r.r_name AS Borough, n.n_name AS Zone,
         r.r_name AS service_zone
  FROM nation n LEFT JOIN region r ON n.n_regionkey = r.r_regionkey
),
stg_zone AS (
  SELECT CAST(LocationID AS INTEGER) AS location_id, Borough AS borough, Zone AS zone_name,
         service_zone, {ts(P.transformed_at)} AS _transformed_at
  FROM zone_seed
),
dim_zone AS (
  SELECT location_id, zone_name, borough, service_zone, _transformed_at AS effective_from,
         md5(CAST(location_id AS VARCHAR)) AS zone_sk
  FROM stg_zone
)"""

# Amounts are summed as integers of hundredths; only the last step makes decimals of them.
DAILY = f"""daily_cents AS (
  SELECT CAST(pickup_at AS DATE) AS pickup_date, pu_location_id, payment_type, count(*) AS trip_count,
    CAST(sum(passenger_count) AS BIGINT) AS total_passengers,
    {cents("trip_distance")} AS distance, {cents("fare_amount")} AS fare, {cents("tip_amount")} AS tip, {cents("total_amount")} AS revenue,
    {cents("tip_pct")} AS tip_pct_total, count(tip_pct) AS tip_pct_n, {cents("duration_min")} AS minutes_total, count(duration_min) AS minutes_n
  FROM fct GROUP BY CAST(pickup_at AS DATE), pu_location_id, payment_type
),
daily AS (
  SELECT {sk("pickup_date", "pu_location_id", "payment_type")} AS daily_id, pickup_date,
    CAST(date_trunc('month', pickup_date) AS DATE) AS pickup_month, pu_location_id, payment_type, trip_count, total_passengers,
    {from_cents("distance")} AS total_distance_mi, {from_cents("fare")} AS total_fare, {from_cents("tip")} AS total_tip,
    {from_cents("revenue")} AS total_revenue, {mean_of_cents("tip_pct_total", "tip_pct_n")} AS avg_tip_pct,
    {mean_of_cents("minutes_total", "minutes_n")} AS avg_duration_min, {ts(P.transformed_at)} AS _transformed_at
  FROM daily_cents
)"""

ZONE_REV = f"""zone_cents AS (
  SELECT pickup_month, pu_location_id, count(*) AS trip_count, {cents("total_amount")} AS revenue, count(total_amount) AS revenue_n,
    {cents("trip_distance")} AS distance, count(trip_distance) AS distance_n, {cents("tip_amount")} AS tip,
    {cents("tip_pct")} AS tip_pct_total, count(tip_pct) AS tip_pct_n
  FROM fct GROUP BY pickup_month, pu_location_id
),
zone_rev AS (
  SELECT {sk("pickup_month", "pu_location_id")} AS zone_month_id, pickup_month, pu_location_id,
    z.borough, z.zone_name, z.service_zone, trip_count, {from_cents("revenue")} AS total_revenue,
    {mean_of_cents("revenue", "revenue_n")} AS avg_revenue_per_trip, {from_cents("distance")} AS total_distance_mi,
    {mean_of_cents("distance", "distance_n")} AS avg_distance_mi, {from_cents("tip")} AS total_tips,
    {mean_of_cents("tip_pct_total", "tip_pct_n")} AS avg_tip_pct, {ts(P.transformed_at)} AS _transformed_at
  FROM zone_cents LEFT JOIN dim_zone z ON z.location_id = pu_location_id
)"""

PAYMENT = f"""dim_payment_type AS (
  SELECT CAST(payment_type_id AS INTEGER) AS payment_type_id, payment_type_desc,
         {ts(P.transformed_at)} AS _transformed_at
  FROM (VALUES (0, 'Voided trip'), (1, 'Credit card'), (2, 'Cash'), (3, 'No charge'), (4, 'Dispute'))
       AS t(payment_type_id, payment_type_desc)
)"""

VENDOR = f"""dim_vendor AS (
  SELECT CAST(vendor_id AS INTEGER) AS vendor_id, vendor_name, {ts(P.transformed_at)} AS _transformed_at
  FROM (VALUES (1, 'Creative Mobile Technologies LLC'), (2, 'VeriFone Inc.')) AS t(vendor_id, vendor_name)
)"""

RATE = f"""dim_rate_code AS (
  SELECT CAST(rate_code_id AS INTEGER) AS rate_code_id, rate_code_desc, {ts(P.transformed_at)} AS _transformed_at
  FROM (VALUES (1, 'Standard rate'), (2, 'JFK'), (3, 'Newark'), (4, 'Nassau or Westchester'),
               (5, 'Negotiated fare'), (6, 'Group ride'), (99, 'Unknown')) AS t(rate_code_id, rate_code_desc)
)"""

# CTE chains, in dependency order.
CHAIN_BRONZE = [RAW, BRONZE_U, LOOKUP, tokens_cte(), bronze_cte()]
CHAIN_FCT = CHAIN_BRONZE + [STG, FCT]
CHAIN_GOLD = CHAIN_FCT + [ZONE, DAILY, ZONE_REV, PAYMENT]


def with_(ctes: list[str], body: str) -> str:
    """``WITH ctes body``; a body that starts with more CTEs continues the list."""
    sep = "\n" if body.lstrip().upper().startswith("SELECT") else ",\n"
    return "WITH " + ",\n".join(ctes) + sep + body


# -- expectation suites and structural tests, recomputed in SQL ------------------


def _lit(v) -> str:
    if isinstance(v, str):
        return "'" + v.replace("'", "''") + "'"
    return repr(v)


def _between_sql(c: str, lo, hi) -> str:
    parts = []
    if lo is not None:
        parts.append(f"{c} >= {_lit(lo)}")
    if hi is not None:
        parts.append(f"{c} <= {_lit(hi)}")
    return "(" + " AND ".join(parts) + ")" if parts else "TRUE"


def _range_ok_sql(obs: str, lo, hi) -> str:
    return f"coalesce({obs} IS NOT NULL AND {_between_sql(obs, lo, hi)}, false)"


def suite_sql(suite, table: str, group: str, decimal_cols: set[str]) -> str:
    """UNION ALL of one grouped SELECT per expectation (mirrors evaluate_suite)."""
    from strata.operators.quality import expectations as X

    selects = []
    for i, e in enumerate(suite):
        k = e.kwargs
        n = "COUNT(*)"
        missing = unexpected = "CAST(NULL AS BIGINT)"
        observed = "CAST(NULL AS DOUBLE)"
        if e.type == X.ROW_COUNT:
            observed = f"CAST({n} AS DOUBLE)"
            success = _range_ok_sql(n, k.get("min_value"), k.get("max_value"))
        elif e.type == X.MEAN:
            c = e.column
            observed = f"CAST({avg_dec(c)} AS DOUBLE)" if c in decimal_cols else f"avg({c})"
            success = _range_ok_sql(observed, k.get("min_value"), k.get("max_value"))
        elif e.type == X.QUANTILE:
            qs = k["quantile_ranges"]["quantiles"]
            ranges = k["quantile_ranges"]["value_ranges"]
            obs = [f"CAST(quantile_disc({e.column}, {q}) AS DOUBLE)" for q in qs]
            observed = obs[0]
            success = " AND ".join(_range_ok_sql(o, lo, hi) for o, (lo, hi) in zip(obs, ranges))
        elif e.type == X.UNIQUE_PROPORTION:
            c = e.column
            observed = f"CAST(COUNT(DISTINCT {c}) AS DOUBLE) / NULLIF(COUNT({c}), 0)"
            success = _range_ok_sql(observed, k.get("min_value"), k.get("max_value"))
            missing = f"{n} - COUNT({c})"
        else:
            if e.type == X.PAIR_GT:
                a, b = k["column_A"], k["column_B"]
                is_missing = f"({a} IS NULL OR {b} IS NULL)"
                bad = f"({a} < {b})" if k.get("or_equal") else f"({a} <= {b})"
            else:
                c = e.column
                is_missing = f"({c} IS NULL)"
                if e.type == X.NOT_NULL:
                    bad = f"({c} IS NULL)"
                elif e.type == X.BETWEEN:
                    bad = f"(NOT {_between_sql(c, k.get('min_value'), k.get('max_value'))})"
                elif e.type == X.LENGTH_EQ:
                    bad = f"(length({c}) <> {k['value']})"
                elif e.type == X.IN_SET:
                    bad = f"({c} NOT IN ({', '.join(_lit(v) for v in k['value_set'])}))"
            if e.type == X.NOT_NULL:
                missing = "CAST(0 AS BIGINT)"
                unexpected = f"COUNT(*) FILTER (WHERE {bad})"
                denom = n
            else:
                missing = f"COUNT(*) FILTER (WHERE {is_missing})"
                unexpected = f"COUNT(*) FILTER (WHERE NOT {is_missing} AND {bad})"
                denom = f"({n} - {missing})"
            observed = f"CAST({unexpected} AS DOUBLE) / NULLIF({denom}, 0)"
            allowed = round((1 - float(k.get("mostly", 1.0))) * 1_000_000)  # of a million
            success = f"({observed} IS NULL OR CAST({unexpected} AS HUGEINT) * 1000000 <= {allowed} * CAST({denom} AS HUGEINT))"
        pct = f"CAST({unexpected} AS DOUBLE) / NULLIF({n} - coalesce({missing}, 0), 0) * 100.0"
        col = _lit(e.column) if e.column else "CAST(NULL AS VARCHAR)"
        selects.append(
            f"SELECT {group}, CAST({i} AS INTEGER) AS expectation_id, {_lit(e.type)} AS expectation_type, {col} AS \"column\", "
            f"{_lit(e.kwargs_json())} AS kwargs, {n} AS element_count, CAST({missing} AS BIGINT) AS missing_count, "
            f"CAST({unexpected} AS BIGINT) AS unexpected_count, {pct} AS unexpected_percent, "
            f"CAST({observed} AS DOUBLE) AS observed_value, {success} AS success FROM {table} GROUP BY {group}"
        )
    return "\nUNION ALL\n".join(selects)


def verdict_sql(results: str, group: str, suite_name: str) -> str:
    failed = "expectation_type || ':' || coalesce(\"column\", 'table')"
    return f"""SELECT {group}, {_lit(suite_name)} AS suite_name, COUNT(*) AS evaluated,
  COUNT(*) FILTER (WHERE success) AS passed,
  CAST(COUNT(*) FILTER (WHERE success) AS DOUBLE) / COUNT(*) AS pass_rate,
  coalesce(list_sort(list({failed}) FILTER (WHERE NOT success)), CAST([] AS VARCHAR[])) AS failed_expectations,
  coalesce(list_sort(list(kwargs) FILTER (WHERE NOT success)), CAST([] AS VARCHAR[])) AS failed_kwargs,
  bool_and(success) AS success
FROM {results} GROUP BY {group}"""


def structural_sql(model: str, table: str, tests, dims: dict[str, str] | None = None) -> list[str]:
    out = []
    for t in tests:
        c = t.column
        head = f"SELECT {_lit(model)} AS model, {_lit(t.kind)} AS test, {_lit(c)} AS \"column\", "
        if t.kind == "not_null":
            out.append(head + f"COUNT(*) FILTER (WHERE {c} IS NULL) AS failures FROM {table}")
        elif t.kind == "accepted_values":
            vals = ", ".join(_lit(v) for v in t.args["values"])
            out.append(head + f"COUNT(*) FILTER (WHERE {c} IS NOT NULL AND {c} NOT IN ({vals})) AS failures FROM {table}")
        elif t.kind == "accepted_range":
            rng = _between_sql(c, t.args.get("min_value"), t.args.get("max_value"))
            out.append(head + f"COUNT(*) FILTER (WHERE {c} IS NOT NULL AND NOT {rng}) AS failures FROM {table}")
        elif t.kind == "unique":
            out.append(head + f"COUNT(*) AS failures FROM (SELECT {c} FROM {table} WHERE {c} IS NOT NULL GROUP BY {c} HAVING COUNT(*) > 1)")
        elif t.kind == "expression_is_true":
            out.append(head + f"COUNT(*) FILTER (WHERE NOT coalesce({t.args['expression']}, FALSE)) AS failures FROM {table}")
        elif t.kind == "relationships":
            d = dims[t.args["to"]]
            out.append(head + f"COUNT(*) AS failures FROM {table} WHERE {c} IS NOT NULL AND {c} NOT IN (SELECT {t.args['field']} FROM {d})")
    return out
