"""The layered deliveries pipeline, built from the generic operators.

bronze:  raw files -> contract -> date range -> tenants -> lineage -> partition replace
silver:  dimension (conform + upsert); fact (dedup -> normalize -> point-in-time
         join -> rules -> one staged intermediate -> quality log, upsert of good
         rows, quarantine of bad rows, per-tenant outcome counts)
gold:    daily metrics of the touched partitions -> partition replace

Every stage processes all requested tenants in one set-based job (the tenant
is the leading partition column), instead of one job per tenant that re-reads
the raw data each time.
"""

from __future__ import annotations

import dataclasses
import uuid
from collections.abc import Callable, Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terrace.config import (
    ACTIVE_TENANTS,
    DEFAULT_RULES,
    GLOBAL_TENANT,
    DELIVERIES,
    DIMENSION_KEYS,
    DISCARD_RULES,
    FACT_KEYS,
    MATERIALS,
    MATERIALS_CONFORM,
    MONTH_KEY,
    ROUTINE_TYPES,
    UNIT_FACTORS,
    EntitySpec,
    Rule,
)
from terrace.functions.columns import MONEY, bound_key, factor_case
from terrace.operators.contract import (
    enforce_contract,
    entity_spec,
    isolate_tenants,
    stamp_global,
    stamp_lineage,
)
from terrace.operators.metrics import DAILY_KEYS, DAILY_MEASURES, daily_metrics, dedup, rounded_operands
from terrace.operators.normalize import NORMALIZED, conform_types, date_range, normalize_deliveries, order_columns
from terrace.operators.quality import (
    CriticalQualityError,
    as_rules,
    counts_from_summary,
    evaluate_rules,
    log_from_summary,
    quarantine_frame,
    route_bad,
    rule_summary,
    rules_for_tenants,
    split_by_quality,
)
from terrace.operators.repeats import Repeats
from terrace.operators.sinks import (
    DuplicateKeyError,
    append,
    duplicate_keys,
    materialize,
    overwrite,
    remove_partitions,
    replace_partitions,
    replace_prefix,
    replace_slices,
    table_schema,
    touched_partitions,
    upsert,
)
from terrace.operators.temporal import point_in_time_join
from terrace.session import UNIQUE_KEYS_CONF, remove_path, session_conf
from terrace.sources.files import MissingTableError, read_source, read_table, require_table, table_exists

MALFORMED = "_malformed_line"
MALFORMED_LAYOUT = ("_file",)
LOG_DATE = "executed_date"
AUDIT_FIELDS = [
    T.StructField("_tenant_id", T.StringType()),
    T.StructField("_ingestion_timestamp", T.TimestampType()),
    T.StructField("_source_file", T.StringType()),
    T.StructField("_batch_id", T.StringType()),
]


@dataclass(frozen=True)
class Layout:
    """Table locations under one root (one table per layer, tenant = leading partition)."""

    root: str

    def bronze(self, entity: str) -> str:
        return f"{self.root}/bronze/{entity}"

    @property
    def dimension(self) -> str:
        return f"{self.root}/silver/dim_materials"

    @property
    def fact(self) -> str:
        return f"{self.root}/silver/fact_deliveries"

    @property
    def quarantine(self) -> str:
        return f"{self.root}/silver_quarantine/fact_deliveries"

    @property
    def gold(self) -> str:
        return f"{self.root}/gold/daily_metrics_by_delivery_type"

    def malformed(self, entity: str) -> str:
        """Raw lines of an entity's files that have the wrong number of values."""
        return f"{self.root}/bronze_malformed/{entity}"

    @property
    def ledger(self) -> str:
        """The slices that runs with ``retract`` processed."""
        return f"{self.root}/shared/processed_slices"

    @property
    def quality_log(self) -> str:
        return f"{self.root}/shared/quality_logs"


@dataclass(frozen=True)
class RunConfig:
    """Parameters of one pipeline run.

    ``partition_by`` is the physical layout of bronze, silver, quarantine and
    gold; ``derived`` adds (name, SQL) columns at bronze, e.g. a month key
    ``("mes", "fecha_proceso div 100")`` for coarser partitions.  Derived
    partition columns must be functions of the fact key.
    """

    tenants: tuple[str, ...] | None = None
    start: str | None = None
    end: str | None = None
    rules: tuple[Rule, ...] = DEFAULT_RULES
    overrides: Mapping[str, Mapping] = field(default_factory=dict)
    discard_rules: tuple[str, ...] = DISCARD_RULES
    unknown: str = "drop"
    fail_on_critical: bool | tuple[str, ...] = False    # the breaker: on for all tenants, or for these
    fail_fast: bool = False
    on_violation: str = "skip"
    malformed: str = "keep"                     # lines with the wrong number of values: "keep" or "quarantine"
    partition_by: tuple[str, ...] = ("_tenant_id", "fecha_proceso")
    derived: tuple[tuple[str, str], ...] = ()
    log_partition_by: tuple[str, ...] = ()      # e.g. ("tenant_id", LOG_DATE): log folders per tenant and day
    deliveries: EntitySpec = DELIVERIES
    materials: EntitySpec = MATERIALS
    money_type: str = MONEY                     # operands of gold's sums
    #: Rows that are good no longer leave silver, mended days leave quarantine, emptied days leave gold.  Off: the
    #: upsert never deletes, and only slices with new bad rows are replaced in quarantine (parity).
    retract: bool = False

    @property
    def slices(self) -> tuple[str, ...]:
        """What a batch replaces: (tenant, date), below the layout's partitions."""
        return (*self.partition_by, *(c for c in ("_tenant_id", "fecha_proceso") if c not in self.partition_by))

    def breaks(self, tenant: str) -> bool:
        """Whether critical failures stop this tenant."""
        on = self.fail_on_critical
        return on if isinstance(on, bool) else tenant in {t.lower() for t in on}

    def effective_rules(self) -> list[Rule]:
        rules = as_rules(self.rules)
        return rules_for_tenants(rules, self.overrides) if self.overrides else rules

    def fact_keys(self) -> list[str]:
        return list(FACT_KEYS) + [c for c in self.partition_by if c not in FACT_KEYS]

    def tenant_list(self) -> list[str] | None:
        return None if self.tenants is None else sorted({t.lower() for t in self.tenants})

    def select_dates(self, df: DataFrame, column: str = "fecha_proceso") -> DataFrame:
        """The run's date range; with a month partition key the range also
        becomes a filter on the month, so whole month partitions are pruned."""
        df = date_range(df, column, self.start, self.end)
        if MONTH_KEY in self.derived and MONTH_KEY[0] in df.columns:
            lo, hi = bound_key(self.start), bound_key(self.end)
            if lo is not None:
                df = df.filter(F.col(MONTH_KEY[0]) >= lo // 100)
            if hi is not None:
                df = df.filter(F.col(MONTH_KEY[0]) <= hi // 100)
        return df


    def select_partitions(self, df: DataFrame) -> DataFrame:
        """All rows of the partitions that hold a day of the run's range (gold is recomputed by whole partitions)."""
        if set(self.partition_by) <= {"_tenant_id", "fecha_proceso"} or self.start is None and self.end is None:
            return self.select_dates(df)
        if MONTH_KEY in self.derived and MONTH_KEY[0] in self.partition_by:
            lo, hi = bound_key(self.start), bound_key(self.end)
            if lo is not None:
                df = df.filter(F.col(MONTH_KEY[0]) >= lo // 100)
            if hi is not None:
                df = df.filter(F.col(MONTH_KEY[0]) <= hi // 100)
            return df
        return touched_partitions(df, self.select_dates(df), self.partition_by)


@dataclass
class StageResult:
    stage: str
    status: str                       # ok | skipped | failed | blocked
    rows: dict[str, int] = field(default_factory=dict)   # per tenant
    reason: str | None = None
    extra: dict = field(default_factory=dict)
    failed: dict[str, str] = field(default_factory=dict)  # tenants that failed although the stage went on


def _tenant_counts(obs: Observation, tenants: list[str] | None) -> dict[str, int]:
    got = obs.get
    if tenants is None:
        return {"*": int(got.get("rows", 0) or 0)}
    return {t: int(got.get(f"t{i}", 0) or 0) for i, t in enumerate(tenants)}


def _observe(df: DataFrame, tenants: list[str] | None, name: str,
             tenant_column: str = "_tenant_id") -> tuple[DataFrame, Observation]:
    obs = Observation(name)
    if tenants is None:
        return df.observe(obs, F.count(F.lit(1)).alias("rows")), obs
    aggs = [F.count_if(F.col(tenant_column) == t).alias(f"t{i}") for i, t in enumerate(tenants)]
    return df.observe(obs, *aggs), obs


def bronze_rows(raw: DataFrame, spec: EntitySpec, tenants: Iterable[str] | None = None,
                start: str | None = None, end: str | None = None) -> DataFrame:
    """Date range, tenants and derived columns of one entity's raw rows."""
    df = date_range(raw, spec.date_column, start, end) if spec.date_column else raw
    df = isolate_tenants(df, spec.tenant_column, tenants) if spec.tenant_column else stamp_global(df)
    return df.withColumns({name: F.expr(sql) for name, sql in spec.derived}) if spec.derived else df


def _conform(raw: DataFrame, spec: EntitySpec, observed: list[Observation] | None) -> DataFrame:
    """Declared types for the columns that have others, NULLs for declared columns that the source
    lacks; undeclared columns stay.  An observation added to ``observed`` counts, per column, the
    values that do not convert."""
    if spec.schema is None:
        return raw
    have = {f.name.lower(): f for f in raw.schema.fields}
    casts, bad = {}, []
    for f in spec.schema.fields:
        old = have.get(f.name.lower())
        if old is None:
            casts[f.name] = F.lit(None).cast(f.dataType)
        elif old.dataType != f.dataType:
            casts[old.name] = F.col(old.name).try_cast(f.dataType)
            bad.append(F.count_if(F.col(old.name).isNotNull() & casts[old.name].isNull()).alias(f.name))
    if observed is not None and bad:
        observed.append(Observation(f"{spec.name}-parsed"))
        raw = raw.observe(observed[-1], *bad)
    return raw.withColumns(casts) if casts else raw


def bronze_frame(spark: SparkSession, source: DataFrame | str | list[str], spec: EntitySpec | str,
                 tenants: Iterable[str] | None = None, start: str | None = None,
                 end: str | None = None, batch_id: str | None = None,
                 on_violation: str = "raise", lineage: bool = True,
                 observed: list[Observation] | None = None, malformed: str = "keep") -> DataFrame | None:
    """The bronze frame of one entity (lazy).  None when the contract check skips it.

    The contract is checked on the columns that the source really has (for
    CSV, its header).  CSV values are read as text and converted here, so that
    an observation (added to ``observed``) can count what does not convert.
    Lines with more or fewer values than the header are counted too;
    ``malformed="quarantine"`` leaves them out, ``"keep"`` takes what they have.
    """
    spec = entity_spec(spec)
    if malformed not in ("keep", "quarantine"):
        raise ValueError("malformed must be 'keep' or 'quarantine'")
    if isinstance(source, DataFrame):
        raw = source
    else:
        schema = spec.schema
        if spec.fmt == "csv" and schema is not None:
            schema = T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields])
        raw = read_source(spark, source, spec.fmt, schema, corrupt=MALFORMED, **spec.options)
    if MALFORMED in raw.columns:
        if observed is not None:
            observed.append(Observation(f"{spec.name}-lines"))
            raw = raw.observe(observed[-1], F.count_if(F.col(MALFORMED).isNotNull()).alias(MALFORMED))
        raw = (raw.filter(F.col(MALFORMED).isNull()) if malformed == "quarantine" else raw).drop(MALFORMED)
    if enforce_contract(raw, spec.required_columns, spec.name, on_violation) is None:
        return None
    if lineage:
        raw = stamp_lineage(raw, batch_id, from_files=not isinstance(source, DataFrame))
    return bronze_rows(_conform(raw, spec, observed), spec, tenants, start, end)


def ingest(spark: SparkSession, source, spec: EntitySpec | str, layout: Layout,
           tenants: Iterable[str] | None = None, start: str | None = None, end: str | None = None,
           batch_id: str | None = None, on_violation: str = "raise", malformed: str = "keep") -> StageResult:
    """Land one entity in bronze.  Transactional entities replace the (tenant,
    date) slices of the batch, whatever the layout; catalogs are a full load.

    The result's reason counts malformed lines and values that do not convert.
    With ``malformed="quarantine"`` the raw lines go to ``layout.malformed``, where a file's
    lines replace those of its last load.
    """
    spec = entity_spec(spec)
    stage = f"bronze_{spec.name}"
    parsed: list[Observation] = []
    df = bronze_frame(spark, source, spec, tenants, start, end, batch_id, on_violation, observed=parsed,
                      malformed=malformed)
    if df is None:
        raw = source if isinstance(source, DataFrame) else read_source(spark, source, spec.fmt, spec.schema, **spec.options)
        missing = [c for c in spec.required_columns if c.lower() not in {x.lower() for x in raw.columns}]
        return StageResult(stage, "skipped", reason=f"missing required columns {missing}")
    tl = None if tenants is None or not spec.tenant_column else sorted({t.lower() for t in tenants})
    df, obs = _observe(df, tl, stage)
    if spec.partition_by:
        replace_slices(spark, df, layout.bronze(spec.name), spec.slices, spec.partition_by)
    else:
        overwrite(df, layout.bronze(spec.name), keep_old_columns=True)
    rows = _tenant_counts(obs, tl)
    if not spec.tenant_column:
        rows = {GLOBAL_TENANT: rows["*"]}
    bad = {c: n for o in parsed for c, n in o.get.items() if n}
    reasons = []
    if n := bad.pop(MALFORMED, 0):
        lines, stage_dir = materialize(spark, malformed_lines(spark, source, spec, batch_id), "malformed")
        try:
            if malformed == "quarantine":
                replace_partitions(lines, layout.malformed(spec.name), MALFORMED_LAYOUT)
            files = lines.select("_source_file").distinct().count()
        finally:
            remove_path(spark, stage_dir)
        reasons.append(f"malformed lines: {n} in {files} files")
    if bad:
        reasons.append(f"unparsable values: {', '.join(f'{c} {n}' for c, n in sorted(bad.items()))}")
    return StageResult(stage, "ok", rows, "; ".join(reasons) or None)


def malformed_lines(spark: SparkSession, source: str | list[str], spec: EntitySpec, batch_id: str | None = None) -> DataFrame:
    """The lines of CSV files that have more or fewer values than the header, with their first value and their file.

    Spark reads a file's raw lines only beside some parsed column, which is what the first value is for.
    """
    schema = T.StructType([T.StructField(f.name, T.StringType()) for f in spec.schema.fields])
    raw = read_source(spark, source, spec.fmt, schema, corrupt=MALFORMED, **spec.options)
    file = F.col("_metadata.file_path")
    return raw.filter(F.col(MALFORMED).isNotNull()).select(
        F.col(MALFORMED).alias("line"), F.col(raw.columns[0]).alias("first_value"), file.alias("_source_file"), F.lit(batch_id).cast("string").alias("_batch_id"),
        F.current_timestamp().alias("_ingestion_timestamp"), F.hex(F.xxhash64(file)).alias(MALFORMED_LAYOUT[0]))


def bronze_schema(spec: EntitySpec, derived_types: Mapping[str, T.DataType] | None = None) -> T.StructType:
    fields = list(spec.schema.fields) + AUDIT_FIELDS
    for name, dtype in (derived_types or {}).items():
        fields.append(T.StructField(name, dtype))
    return T.StructType(fields)


def conform_dimension(bronze_materials: DataFrame) -> DataFrame:
    """Type the catalog: price double, validity dates, current flag boolean."""
    return conform_types(bronze_materials, MATERIALS_CONFORM)


DIMENSION_BUCKETS = ("_bucket", "CAST(pmod(xxhash64(CAST(material AS STRING)), 16) AS INT)")


def build_dimension(spark: SparkSession, layout: Layout, materials: EntitySpec = MATERIALS) -> StageResult:
    """Conform the bronze catalog and upsert it on (material, valid_from).

    The table is partitioned by a hash of the material, so an update rewrites
    the buckets it touches and the others stay in place for readers.
    """
    path = layout.bronze(materials.name)
    if not table_exists(spark, path):
        return StageResult("silver_dim_materials", "skipped", reason=f"no bronze catalog at {path}")
    src = read_table(spark, path, schema=table_schema(spark, path, like=bronze_schema(materials)))
    dim = conform_dimension(src).withColumn(DIMENSION_BUCKETS[0], F.expr(DIMENSION_BUCKETS[1]))
    obs = Observation("dim")
    dim = dim.observe(obs, F.count(F.lit(1)).alias("rows"))
    upsert(spark, dim, layout.dimension, (*DIMENSION_KEYS, DIMENSION_BUCKETS[0]), (DIMENSION_BUCKETS[0],))
    return StageResult("silver_dim_materials", "ok", {"global": int(obs.get.get("rows", 0))})


def silver_evaluate(bronze: DataFrame, dimension: DataFrame, rules=DEFAULT_RULES,
                    deduplicate: bool = True):
    """dedup -> normalize -> point-in-time price -> rule columns.  Returns (df, cond)."""
    df = dedup(bronze) if deduplicate else bronze
    df = normalize_deliveries(df)
    df = point_in_time_join(df, dimension.select("material", "valid_from", "valid_to", "precio_base"),
                            ["material"], at="fecha_proceso_dt",
                            columns={"precio_base": "precio_catalogo_unitario"})
    return evaluate_rules(df, rules)


def silver_rows(good: DataFrame, keys: Iterable[str] = FACT_KEYS, timestamp: bool = True) -> DataFrame:
    """Good rows in the standard column order (keys, metrics, audit)."""
    if timestamp:
        good = good.withColumn("_silver_timestamp", F.current_timestamp())
    return order_columns(good, keys)


#: The price lookup does not sort the facts where every shuffled piece of the dimension is this small.
LOOKUP_CONF = {"spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64MB"}


def build_fact(spark: SparkSession, layout: Layout, cfg: RunConfig,
               run_id: str | None = None, stage: bool = True) -> StageResult:
    """Silver fact for all requested tenants.

    The evaluated rows are staged once in the shared folder; the quality log,
    the upsert of good rows, the quarantine write and the outcome counts all
    read that stage (each with its own column pruning) instead of recomputing
    the dedup and join per consumer.  The stage holds the bronze columns, the
    price and the rules' outcomes; the normalized columns are made anew from
    each row, which is cheaper than shuffling and writing them.  ``stage=False``
    lets every consumer recompute the plan (kept for measurement).
    """
    run_id = run_id or str(uuid.uuid4())
    require_table(spark, layout.dimension, "dim_materials")
    bronze_path = layout.bronze(cfg.deliveries.name)
    if not table_exists(spark, bronze_path):
        return StageResult("silver_fact_deliveries", "skipped", reason=f"no bronze deliveries at {bronze_path}")
    derived_types = {name: T.IntegerType() for name, _ in cfg.derived}
    bronze = read_table(spark, bronze_path, schema=table_schema(
        spark, bronze_path, like=bronze_schema(cfg.deliveries, derived_types)))
    tenants = cfg.tenant_list()
    if tenants is not None:
        bronze = bronze.filter(F.col("_tenant_id").isin(tenants))
    bronze = cfg.select_dates(bronze)
    dim = read_table(spark, layout.dimension, schema=table_schema(spark, layout.dimension))
    rules = cfg.effective_rules()
    keys = cfg.fact_keys()
    # Copies and doubled keys are looked for by hash: rows that have neither are not shuffled for it.
    repeats = Repeats(spark, bronze, keys, "_tenant_id")
    stages = [repeats.path]
    try:
        evaluated, cond = silver_evaluate(repeats.dedup(bronze), dim, rules, deduplicate=False)
        if stage:
            with session_conf(spark, {**LOOKUP_CONF, **UNIQUE_KEYS_CONF}):
                staged, stage_dir = materialize(spark, evaluated.drop(*NORMALIZED), "silver-evaluated")
            stages.append(stage_dir)
            staged = normalize_deliveries(staged).select(*evaluated.columns)
        else:
            staged = evaluated
        # One aggregation yields the log, the outcome counts and the breaker
        # input; it is tiny (one row per tenant) and staged for both consumers.
        summary, summary_dir = materialize(
            spark, rule_summary(staged, rules, discard_rules=cfg.discard_rules, unknown=cfg.unknown),
            "silver-summary")
        stages.append(summary_dir)
        counts = {r["tenant"]: {k: int(v or 0) for k, v in r.asDict().items() if k != "tenant"}
                  for r in counts_from_summary(summary).join(
                      summary.select("tenant", "critical_failed"), "tenant").collect()}
        good, bad = split_by_quality(staged, cond, cfg.unknown)
        # A tenant with two rows of one key fails alone; at most one row per tenant reaches the driver.
        suspects = repeats.candidates(good)
        with session_conf(spark, UNIQUE_KEYS_CONF):
            twice = duplicate_keys(suspects, keys).groupBy("_tenant_id").agg(
                F.count(F.lit(1)).alias("n"), F.min(F.to_json(F.struct(*keys))).alias("key")).collect() if suspects else []
        failed = {r["_tenant_id"]: f"DuplicateKeyError: {r['n']} upsert keys occur more than once, e.g. {r['key']}"
                  for r in twice}
        if failed:
            if cfg.fail_fast:
                raise DuplicateKeyError("; ".join(f"{t}: {why}" for t, why in sorted(failed.items())))
            good, bad = (x.filter(~F.col("_tenant_id").isin(sorted(failed))) for x in (good, bad))
            counts = {t: c for t, c in counts.items() if t not in failed}
        processed = None
        if cfg.retract:
            # every slice that bronze holds for the run is judged anew in full; the ledger tells gold, too
            processed, ledger_dir = materialize(spark, staged.filter(~F.col("_tenant_id").isin(sorted(failed))).select(
                *cfg.slices).distinct(), "silver-ledger")
            stages.append(ledger_dir)
            append(processed.withColumn("_run_id", F.lit(run_id)).withColumn("processed_at", F.current_timestamp()),
                   layout.ledger)
        quarantine, _ = route_bad(bad, rules, cfg.discard_rules, cfg.unknown)
        quarantine = quarantine_frame(quarantine, rules, cfg.discard_rules, cfg.unknown)
        # Independent tables: both writes are submitted at once.
        with ThreadPoolExecutor(2) as pool:
            writes = [
                pool.submit(upsert, spark, silver_rows(good, FACT_KEYS), layout.fact, keys, cfg.partition_by,
                            check_duplicates=False, stage_source=False, processed=processed),
                pool.submit(replace_slices, spark, quarantine, layout.quarantine, cfg.slices, cfg.partition_by,
                            stage_source=False, processed=processed)]
            for w in writes:
                w.result()
        # last, so that a stage that breaks on its way has logged nothing and its retry logs once
        log = log_from_summary(summary, rules, run_id)
        if LOG_DATE in cfg.log_partition_by:
            log = log.withColumn(LOG_DATE, F.to_date("executed_at"))
        append(log, layout.quality_log, cfg.log_partition_by)
    finally:
        for p in stages:
            remove_path(spark, p)
    return StageResult("silver_fact_deliveries", "ok",
                       {t: c["good"] for t, c in counts.items()},
                       extra={"counts": counts, "run_id": run_id}, failed=failed)


def partition_types(cfg: RunConfig) -> T.StructType:
    """Types of the layout's partition columns (tenant string, date and derived keys int)."""
    return T.StructType([T.StructField(c, T.StringType() if c == "_tenant_id" else T.IntegerType())
                         for c in cfg.partition_by])


def gold_frame(silver: DataFrame, partition_by: Iterable[str] = ("_tenant_id", "fecha_proceso"),
               money_type: str = MONEY, table: DataFrame | None = None) -> DataFrame:
    keys = list(DAILY_KEYS) + [c for c in partition_by if c not in DAILY_KEYS]
    return daily_metrics(silver, keys, DAILY_MEASURES, money_type=money_type, table=table)


def build_metrics(spark: SparkSession, layout: Layout, cfg: RunConfig,
                  blocked: Iterable[str] = ()) -> StageResult:
    """Gold: recompute the daily metrics of the partitions that hold the selected dates and replace them.

    The result's reason counts operands that ``cfg.money_type`` rounds.
    """
    if not table_exists(spark, layout.fact):
        return StageResult("gold_daily_metrics", "skipped", reason=f"no silver fact at {layout.fact}")
    silver = read_table(spark, layout.fact,
                        schema=table_schema(spark, layout.fact, like=partition_types(cfg)))
    tenants = cfg.tenant_list()
    blocked = sorted(set(blocked))
    if tenants is not None:
        tenants = [t for t in tenants if t not in blocked]
        silver = silver.filter(F.col("_tenant_id").isin(tenants))
    elif blocked:
        silver = silver.filter(~F.col("_tenant_id").isin(blocked))
    silver = cfg.select_partitions(silver)
    misfits = Observation("gold-operands")
    observed = silver.observe(misfits, F.count_if(rounded_operands(DAILY_MEASURES, cfg.money_type)).alias("n"))
    gold, obs = _observe(gold_frame(observed, cfg.partition_by, cfg.money_type, silver), tenants, "gold")
    with session_conf(spark, UNIQUE_KEYS_CONF):
        replace_partitions(gold, layout.gold, cfg.partition_by)
    if cfg.retract and table_exists(spark, layout.ledger):
        _clear_emptied(spark, layout, cfg, tenants, blocked)
    n = int(misfits.get.get("n", 0) or 0)
    reason = f"{n} rows with operands that {cfg.money_type} rounds" if n else None
    return StageResult("gold_daily_metrics", "ok", _tenant_counts(obs, tenants), reason)


def _clear_emptied(spark: SparkSession, layout: Layout, cfg: RunConfig, tenants: list[str] | None,
                   blocked: Iterable[str]) -> None:
    """Remove gold's partitions of processed slices that silver holds no longer."""
    pb = list(cfg.partition_by)
    ledger = read_table(spark, layout.ledger, schema=table_schema(spark, layout.ledger))
    if tenants is not None:
        ledger = ledger.filter(F.col("_tenant_id").isin(tenants))
    ledger = ledger.filter(~F.col("_tenant_id").isin(list(blocked)))
    silver = read_table(spark, layout.fact, schema=table_schema(spark, layout.fact, like=partition_types(cfg)))
    here = silver.select(*[F.col(c).alias(f"__{c}") for c in pb]).distinct()
    same = F.lit(True)
    for c in pb:
        same = same & F.col(c).eqNullSafe(F.col(f"__{c}"))
    remove_partitions(cfg.select_dates(ledger).select(*pb).distinct().join(here, same, "left_anti"), layout.gold, pb)


STATUS_SCHEMA = T.StructType([
    T.StructField("tenant", T.StringType()),
    T.StructField("stage", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("rows", T.LongType()),
    T.StructField("reason", T.StringType()),
])


def run(spark: SparkSession, deliveries_source, materials_source, layout: Layout,
        cfg: RunConfig = RunConfig(), batch_id: str | None = None) -> DataFrame:
    """Whole run: catalog (bronze + dimension), then bronze, silver and gold
    deliveries for all tenants at once.  Returns a status table
    ``(tenant, stage, status, rows, reason)``.

    A tenant's failure is its own: tenants with duplicate keys are ``failed``
    and the others go on; a stage that breaks otherwise is run again tenant by
    tenant.  Later stages are skipped for a failed tenant only.  A tenant whose
    critical rules failed is ``blocked`` from gold when its breaker
    (``fail_on_critical``) is on.  With ``fail_fast`` the first failure, and a
    breaker that trips, is raised instead.
    """
    status: list[tuple] = []
    if cfg.tenants is None:                   # "all": the configured active tenants
        cfg = dataclasses.replace(cfg, tenants=ACTIVE_TENANTS)
    everyone = cfg.tenant_list()

    def record(res: StageResult, tenants: Iterable[str]) -> None:
        for t in tenants:
            if t in res.failed:
                status.append((t, res.stage, "failed", 0, res.failed[t]))
                continue
            n = int(res.rows.get(t, 0))
            st, why = (res.status, res.reason) if res.status != "ok" or n else ("skipped", "no rows for tenant")
            status.append((t, res.stage, st, n, why))

    def guarded(stage: str, fn: Callable[[RunConfig], StageResult], tenants: list[str]) -> StageResult:
        """Run a stage for all tenants, on an error for each alone; never raises unless fail_fast."""
        def attempt(some: list[str]) -> StageResult:
            try:
                return fn(cfg if some == ["global"] else dataclasses.replace(cfg, tenants=tuple(some)))
            except Exception as exc:  # noqa: BLE001 - isolate the failure in the status table
                if cfg.fail_fast:
                    raise
                return StageResult(stage, "failed", reason=f"{type(exc).__name__}: {exc}")

        res = attempt(tenants)
        if res.status == "failed" and len(tenants) > 1:
            each = {t: attempt([t]) for t in tenants}
            if any(r.status != "failed" for r in each.values()):
                done = [r for r in each.values() if r.status != "failed"]
                res = StageResult(stage, "ok", {t: r.rows.get(t, 0) for t, r in each.items()},
                                  next((r.reason for r in done if r.reason), None),
                                  {"counts": {t: c for r in done for t, c in r.extra.get("counts", {}).items()}},
                                  {t: r.failed.get(t, r.reason) for t, r in each.items()
                                   if r.status == "failed" or t in r.failed})
        if res.status == "failed":
            res.failed = {t: res.failed.get(t, res.reason) for t in tenants}
        record(res, tenants)
        return res

    def skip(stages: Iterable[str], cause: StageResult, tenants: Iterable[str]) -> None:
        for stage in stages:
            for t in tenants:
                why = "failed" if t in cause.failed else cause.status
                status.append((t, stage, "skipped", 0, f"{cause.stage} {why}"))

    guarded(f"bronze_{cfg.materials.name}",
            lambda c: ingest(spark, materials_source, c.materials, layout, batch_id=batch_id,
                             on_violation=c.on_violation, malformed=c.malformed), ["global"])
    guarded("silver_dim_materials", lambda c: build_dimension(spark, layout, c.materials), ["global"])

    spec = dataclasses.replace(cfg.deliveries, partition_by=cfg.partition_by, derived=cfg.derived)
    bronze = guarded(f"bronze_{spec.name}",
                     lambda c: ingest(spark, deliveries_source, spec, layout, c.tenants, c.start, c.end,
                                      batch_id=batch_id, on_violation=c.on_violation, malformed=c.malformed), everyone)
    parts = (("silver_quarantine", "quarantined"), ("silver_discarded", "discarded"), ("silver_lost", "lost"))
    later = ("silver_fact_deliveries", *(stage for stage, _ in parts), "gold_daily_metrics")
    landed = [t for t in everyone if bronze.status == "ok" and t not in bronze.failed]
    skip(later, bronze, [t for t in everyone if t not in landed])
    if not landed:
        return spark.createDataFrame(status, STATUS_SCHEMA)

    fact = guarded("silver_fact_deliveries", lambda c: build_fact(spark, layout, c), landed)
    counts = fact.extra.get("counts", {})
    built = [t for t in landed if fact.status == "ok" and t not in fact.failed]
    for stage, key in parts:
        record(StageResult(stage, "ok", {t: counts.get(t, {}).get(key, 0) for t in built}), built)
    skip(later[1:], fact, [t for t in landed if t not in built])
    blocked = sorted(t for t in built if cfg.breaks(t) and counts.get(t, {}).get("critical_failed", 0) > 0)
    if blocked and cfg.fail_fast:
        raise CriticalQualityError(blocked)
    clear = [t for t in built if t not in blocked]
    if clear:
        guarded("gold_daily_metrics", lambda c: build_metrics(spark, layout, c), clear)
    for t in blocked:
        status.append((t, "gold_daily_metrics", "blocked", 0, "critical quality failures"))
    return spark.createDataFrame(status, STATUS_SCHEMA)


def routine_extract(df: DataFrame, countries: Iterable[str],
                    routine_types: Iterable[str] = ROUTINE_TYPES) -> DataFrame:
    """Routine deliveries of the given countries (exact match), quantity in the
    standard unit, line total, renamed date."""
    qty = factor_case("unidad", "cantidad", UNIT_FACTORS)
    return (df.filter(F.col("pais").isin(list(countries)) & F.col("tipo_entrega").isin(list(routine_types)))
            .select("pais", F.col("fecha_proceso").alias("fecha"), "material",
                    qty.alias("cantidad_st"), (qty * F.col("precio")).alias("total")))


def write_routine_extract(df: DataFrame, path: str, country: str,
                          partition_by: Iterable[str] = ("pais", "fecha")) -> None:
    """Replace everything of ``country`` in the extract table (stale dates removed)."""
    replace_prefix(df, path, {"pais": country}, partition_by)


__all__ = [
    "Layout", "RunConfig", "StageResult", "bronze_frame", "ingest", "build_dimension", "build_fact",
    "build_metrics", "run", "silver_evaluate", "silver_rows", "gold_frame", "conform_dimension",
    "routine_extract", "write_routine_extract", "MissingTableError",
]
