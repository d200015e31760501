"""DataFrame -> DataFrame operators and table sinks."""

from terrace.operators.contract import (  # noqa: F401
    ContractViolation,
    check_contract,
    enforce_contract,
    entity_spec,
    isolate_tenants,
    stamp_global,
    stamp_lineage,
)
from terrace.operators.metrics import DAILY_KEYS, DAILY_MEASURES, Measure, daily_metrics, dedup  # noqa: F401
from terrace.operators.normalize import (  # noqa: F401
    class_flags,
    conform_types,
    date_range,
    normalize_deliveries,
    normalize_units,
    order_columns,
    parse_process_date,
)
from terrace.operators.quality import (  # noqa: F401
    CriticalQualityError,
    action_frame,
    critical_tenants,
    enforce_critical,
    evaluate_rules,
    failure_reasons,
    outcome_counts,
    quality_log,
    quarantine_frame,
    route_bad,
    rule_condition,
    rules_for_tenants,
    split_by_quality,
)
from terrace.operators.sinks import (  # noqa: F401
    DuplicateKeyError,
    append,
    materialize,
    overwrite,
    recover,
    replace_partitions,
    replace_prefix,
    replace_slices,
    upsert,
)
from terrace.operators.temporal import newest_versions, point_in_time_join  # noqa: F401
