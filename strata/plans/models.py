"""The model graph over one trip source, as lazily built DataFrames.

Model order: landing -> bronze (cast, align, stamp) -> pii lookup -> tokenised bronze
-> stg_trips -> fct_trips -> {fct_trips_daily, fct_zone_revenue_monthly,
fct_tokenization_audit} -> serving; zone seed -> stg_zone -> {scd2 snapshot,
dim_taxi_zone}. Nothing is cached: each consumer is one Spark plan, and Catalyst
prunes what a consumer does not read.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from strata.operators import dims, facts, ingest, privacy, silver
from strata.sources import testbed


@dataclass(frozen=True)
class RunParams:
    """Run parameters; timestamps are parameters so every output is reproducible."""

    run_id: str = "run-0001"
    source_url: str = "testbed://lineitem"
    source_sha256: str = ""
    ingested_at: str = "2024-02-01 02:00:00"
    transformed_at: str = "2024-02-01 03:00:00"
    salt: str = "strata-salt-v1"
    salt_version: int = 1
    schema_version: int = 1
    months: tuple[dt.date, ...] | None = field(default=None)


class TripModels:
    """Every model of the graph for one landed trip frame and one zone seed."""

    def __init__(self, spark: SparkSession, raw: DataFrame, zone_seed: DataFrame, params: RunParams = RunParams()):
        self.spark = spark
        self.raw = raw
        self.zone_seed = zone_seed
        self.p = params

    @classmethod
    def from_testbed(cls, spark: SparkSession, sf_dir: str, params: RunParams = RunParams()) -> "TripModels":
        return cls(spark, testbed.trips_raw(spark, sf_dir), testbed.zone_seed(spark, sf_dir), params)

    @property
    def months(self):
        return list(self.p.months) if self.p.months else None

    @cached_property
    def bronze_untokenized(self) -> DataFrame:
        return ingest.bronze_from_landing(
            self.raw, self.p.run_id, self.p.source_url, self.p.source_sha256,
            self.p.ingested_at, self.p.schema_version,
        )

    @cached_property
    def pii_lookup(self) -> DataFrame:
        return privacy.build_pii_lookup(self.bronze_untokenized)

    @cached_property
    def bronze(self) -> DataFrame:
        # The lookup here is built from these very rows, so the token join is evaluated as
        # a projection in the same pass (same values; see tokenize_with_fresh_lookup).
        # Stored lookups (run_month, rotation, erasure) go through the join.
        return privacy.tokenize_with_fresh_lookup(self.bronze_untokenized, self.p.salt, self.p.salt_version)

    @cached_property
    def stg_trips(self) -> DataFrame:
        return silver.stg_trips(self.bronze, self.p.transformed_at, self.months)

    @cached_property
    def stg_zone(self) -> DataFrame:
        return silver.stg_zone(self.zone_seed, self.p.transformed_at)

    @cached_property
    def dim_zone(self) -> DataFrame:
        return dims.dim_zone(self.stg_zone)

    @cached_property
    def dim_payment_type(self) -> DataFrame:
        return dims.dim_payment_type(self.spark, self.p.transformed_at)

    @cached_property
    def dim_vendor(self) -> DataFrame:
        return dims.dim_vendor(self.spark, self.p.transformed_at)

    @cached_property
    def dim_rate_code(self) -> DataFrame:
        return dims.dim_rate_code(self.spark, self.p.transformed_at)

    @cached_property
    def fct_trips(self) -> DataFrame:
        return facts.fct_trips(self.stg_trips, self.p.transformed_at)

    @cached_property
    def fct_trips_daily(self) -> DataFrame:
        return facts.fct_trips_daily(self.fct_trips, self.p.transformed_at)

    @cached_property
    def fct_zone_revenue_monthly(self) -> DataFrame:
        return facts.fct_zone_revenue_monthly(self.fct_trips, self.dim_zone, self.p.transformed_at)

    @cached_property
    def fct_tokenization_audit(self) -> DataFrame:
        return facts.fct_tokenization_audit(self.fct_trips, self.p.transformed_at)

    @cached_property
    def v_trips_summary(self) -> DataFrame:
        return facts.v_trips_summary(self.fct_trips_daily, self.dim_zone, self.dim_payment_type)

    @cached_property
    def v_zone_revenue(self) -> DataFrame:
        return facts.v_zone_revenue(self.fct_zone_revenue_monthly)
