"""Header CSV sources, read as strings with an explicit schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CORRUPT = "_corrupt_record"

# The columns of each source, in file order.
GOLD_COLUMNS = {
    "quality": [
        "metric_id", "product_sku", "product_name", "batch_id", "inspection_date",
        "inspection_time", "defect_type", "defect_category", "defect_count", "total_inspected",
        "defect_rate_percent", "defect_rate_ppm", "inspection_stage", "inspector_id",
        "inspector_name", "measurement_tool", "corrective_action", "corrective_action_date",
        "specification_limit_percent", "specification_type", "cost_impact_usd", "rework_hours",
        "scrap_count", "line_id", "equipment_id", "shift", "temperature_c", "humidity_percent",
    ],
    "production": [
        "metric_id", "line_id", "shift_date", "shift", "planned_production_time_min",
        "downtime_min", "operating_time_min", "ideal_cycle_time_sec", "total_units_produced",
        "good_units", "defect_units", "availability_percent", "performance_percent",
        "quality_percent", "oee_percent", "target_oee_percent", "equipment_ids_used",
        "crew_size", "shift_supervisor", "notes",
    ],
    "maintenance": [
        "maintenance_id", "equipment_id", "equipment_name", "equipment_type", "line_id",
        "maintenance_type", "maintenance_category", "maintenance_date", "start_time",
        "end_time", "duration_hours", "technician_id", "technician_name", "certification_level",
        "parts_replaced", "part_numbers", "parts_cost_usd", "labor_cost_usd", "total_cost_usd",
        "work_performed", "work_order_id", "failure_mode", "next_maintenance_date",
        "maintenance_interval_days", "equipment_status", "downtime_impact",
        "pm_compliance_percent", "mtbf_hours", "work_priority", "vendor_service",
    ],
    "incident": [
        "incident_id", "incident_date", "equipment_name", "equipment_type", "line_id",
        "failure_type", "failure_category", "root_cause", "downtime_minutes",
        "resolution_action", "severity", "shift", "reported_by", "verified_by",
        "environmental_temp_c", "humidity_percent", "production_impact_units", "labor_hours",
        "parts_cost_usd", "mttr_minutes", "mtbf_hours",
    ],
    "sop": [
        "sop_id", "document_title", "document_type", "equipment_id", "equipment_name",
        "version", "effective_date", "review_date", "author", "approver",
        "regulatory_reference", "page_count", "word_count", "last_updated", "content_text",
    ],
}


def gold_schema(kind: str) -> T.StructType:
    """All columns of one source as strings, plus the raw line of a row that does not fit."""
    names = GOLD_COLUMNS[kind] + [CORRUPT]
    return T.StructType([T.StructField(name, T.StringType()) for name in names])


def read_gold(spark: SparkSession, kind: str, path: str, multi_line: bool = False) -> DataFrame:
    """Every row of the files, good or not. Column pruning is off so that a wrong number of
    fields is noticed whichever columns are used later."""
    return (
        spark.read.schema(gold_schema(kind))
        .option("header", True)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .option("multiLine", multi_line)
        .option("columnPruning", False)
        .option("enforceSchema", False)
        .csv(path)
    )


def split_corrupt(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Good rows without the raw line; of the rest, the raw line and the first field."""
    first = rows.columns[0]
    # Spark refuses a scan of the raw line alone (as a count would need), so the test looks at
    # the first field too; a length is never negative.
    is_bad = F.col(CORRUPT).isNotNull() & (F.coalesce(F.length(first), F.lit(0)) >= 0)
    good = rows.where(~is_bad).drop(CORRUPT)
    bad = rows.where(is_bad).select(
        F.col(first).alias("first_field"), F.col(CORRUPT).alias("raw_line")
    )
    return good, bad


LINE_REASONS = [
    "BLANK_LINE", "HEADER_LINE", "OPEN_QUOTE", "TOO_FEW_FIELDS", "TOO_MANY_FIELDS", "MALFORMED"]
_CSV = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT, "quote": '"', "escape": '"'}
_QUOTED = '"(?:[^"]|"")*"'


def count_fields(line: Column) -> Column:
    """Fields of a CSV line: commas outside of quotes, and one."""
    bare = F.regexp_replace(line, _QUOTED, "")
    return F.length(bare) - F.length(F.replace(bare, F.lit(","), F.lit(""))) + 1


def parse_lines(lines: DataFrame, kind: str, line_col: str = "line") -> DataFrame:
    """Lines of header CSV, from wherever they come, as the columns of a source.

    Other columns stay. Adds ``n_fields`` and ``reject_reason`` (null = good), the first of
    ``LINE_REASONS`` that holds; a rejected line's fields are null, so that no value ends up in
    a column beside its own. Repeated header lines, one per file, are rejected like all that is no data.
    An empty field is null. Null lines count as blank. Columns named like the source's are replaced.
    """
    names = GOLD_COLUMNS[kind]
    text = F.col(line_col)
    schema = ", ".join(f"`{n}` STRING" for n in [*names, CORRUPT])
    header = ",".join(names)
    n, quotes = F.col("n_fields"), F.length(text) - F.length(F.replace(text, F.lit('"'), F.lit("")))
    kept = [c for c in lines.columns if c not in {*names, "n_fields", "reject_reason"}]
    read = lines.select(*kept).withColumn("n_fields", count_fields(text)).withColumn(
        "_fields", F.from_csv(text, schema, _CSV))
    reason = (
        F.when(text.isNull() | (F.trim(text) == ""), LINE_REASONS[0])
        .when(F.replace(F.trim(text), F.lit('"'), F.lit("")) == header, LINE_REASONS[1])
        .when(quotes % 2 == 1, LINE_REASONS[2])
        .when(n < len(names), LINE_REASONS[3])
        .when(n > len(names), LINE_REASONS[4])
        .when(F.col(f"_fields.{CORRUPT}").isNotNull(), LINE_REASONS[5])
    )
    judged = read.withColumn("reject_reason", reason)
    good = F.col("reject_reason").isNull()
    return judged.select(
        *kept, *[F.when(good, F.col(f"_fields.`{name}`")).alias(name) for name in names],
        F.when(~F.coalesce(F.trim(text) == "", F.lit(True)), n).alias("n_fields"), "reject_reason")


def good_rows(parsed: DataFrame, kind: str) -> DataFrame:
    """The columns of the source, of lines that hold them all."""
    return parsed.where(F.col("reject_reason").isNull()).select(*GOLD_COLUMNS[kind])


def rejected_lines(parsed: DataFrame, line_col: str = "line") -> DataFrame:
    """The other side: what was read, how many fields it has, and why it is no row."""
    return parsed.where(F.col("reject_reason").isNotNull()).select(
        F.col(line_col).alias("raw_line"), F.col("n_fields").cast("int").alias("n_fields"),
        "reject_reason")
