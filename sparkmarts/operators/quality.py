"""Data-quality checks. Each check returns the failing rows as a DataFrame
(empty = pass); :func:`run_checks` evaluates many checks and returns one
report row per check.

Row-level checks on the same relation (not_null, not_negative) are fused into
a single aggregation with ``count_if``, so each relation is scanned once for
all of them; key checks (unique, relationships) need their own shuffle.

Row-level checks of a relation that a job computes anyway cost no scan at all: a
:class:`Watch` counts them while its rows pass (observed metrics), be it a table
that is being written or a view on the way to one."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from sparkmarts.settings import DEFAULT_SETTINGS
from sparkmarts.sources.sinks import store_failures

REPORT_SCHEMA = "check_name string, relation string, column_name string, severity string, failures bigint, status string"


# -- single checks: failing rows ---------------------------------------------------
def not_null_failures(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNull())


def not_negative_failures(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column) < 0)


def unique_failures(df: DataFrame, column: str) -> DataFrame:
    """Values occurring more than once (NULLs ignored), with their count."""
    return (
        df.where(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("n_records"))
        .where(F.col("n_records") > 1)
    )


def accepted_values_failures(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    """Values outside ``values`` (NULL is not reported), with their count."""
    return (
        df.where(~F.col(column).isin(list(values)))
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("n_records"))
    )


def relationships_failures(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Child rows whose non-NULL ``column`` has no match in the parent."""
    keys = parent.select(F.col(parent_column).alias("_parent_key"))
    return child.where(F.col(column).isNotNull()).join(keys, F.col(column) == F.col("_parent_key"), "left_anti")


def valid_currency_code_failures(df: DataFrame, column: str, fx_rates: DataFrame) -> DataFrame:
    """Rows with a non-NULL code absent from the fx rates."""
    return relationships_failures(df, column, fx_rates, "currency_code")


def gross_gte_net_failures(fct_orders: DataFrame) -> DataFrame:
    """Orders whose net revenue exceeds the gross revenue (NULLs pass)."""
    return fct_orders.where(F.col("net_revenue") > F.col("gross_revenue")).select(
        "order_key", "gross_revenue", "net_revenue"
    )


def months_complete_failures(agg_by_nation: DataFrame) -> DataFrame:
    """(nation, year) pairs before the latest year without 12 months. A year
    with no rows at all is not reported. The latest year is a scalar
    subquery, pushed into the scan's filter."""
    latest = agg_by_nation.agg(F.max("order_year")).scalar()
    return (
        agg_by_nation.where(F.col("order_year") < latest)
        .groupBy("nation_name", "order_year")
        .agg(F.count_distinct("order_month").alias("month_count"))
        .where(F.col("month_count") != 12)
    )


# -- check registry and runner ---------------------------------------------------------
@dataclass(frozen=True)
class Check:
    kind: str  # not_null | not_negative | unique | accepted_values | relationships | valid_currency_code
    relation: str
    column: str
    severity: str = DEFAULT_SETTINGS.default_severity
    values: tuple = ()
    parent: str | None = None
    parent_column: str | None = None

    @property
    def name(self) -> str:
        return f"{self.kind}:{self.relation}.{self.column}"


@dataclass
class CheckSuite:
    checks: list[Check] = field(default_factory=list)

    def add(self, kind: str, relation: str, columns: Iterable[str] | str, **kw) -> "CheckSuite":
        for c in [columns] if isinstance(columns, str) else columns:
            self.checks.append(Check(kind, relation, c, **kw))
        return self


ROW_LEVEL = {"not_null", "not_negative"}
PER_VALUE = {"unique", "accepted_values"}
FUSED = ROW_LEVEL | PER_VALUE


def failures_of(check: Check, relations: dict[str, DataFrame]) -> DataFrame:
    df = relations[check.relation]
    if check.kind == "not_null":
        return not_null_failures(df, check.column)
    if check.kind == "not_negative":
        return not_negative_failures(df, check.column)
    if check.kind == "unique":
        return unique_failures(df, check.column)
    if check.kind == "accepted_values":
        return accepted_values_failures(df, check.column, check.values)
    if check.kind == "relationships":
        return relationships_failures(df, check.column, relations[check.parent], check.parent_column)
    if check.kind == "valid_currency_code":
        return valid_currency_code_failures(df, check.column, relations[check.parent or "fx_rates"])
    raise ValueError(f"unknown check kind {check.kind!r}")


def _row_condition(check: Check):
    return F.col(check.column).isNull() if check.kind == "not_null" else F.col(check.column) < 0


def _report_rows(checks: Sequence[Check], counts: Sequence[str]):
    """One report row per check, unpivoted from the columns ``counts`` of a one-row DataFrame."""
    text = lambda x: "'" + x.replace("\\", "\\\\").replace("'", "\\'") + "'"
    rows = [
        f"struct({text(c.name)} AS check_name, {text(c.relation)} AS relation, {text(c.column)} AS column_name, "
        f"{text(c.severity)} AS severity, coalesce(CAST({n} AS BIGINT), 0L) AS failures)"
        for c, n in zip(checks, counts)
    ]
    return F.expr(f"inline(array({', '.join(rows)}))")


def _fused_relation_report(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """All not_null / not_negative / unique / accepted_values checks of one
    relation in a single pass: one scan, and (when a per-value check exists)
    one shuffle of a grouping-sets aggregation, one set per checked column.
    Each input row falls in exactly one group of the first set, so row-level
    counts are summed over that set only."""
    row_checks = [c for c in checks if c.kind in ROW_LEVEL]
    value_checks = [c for c in checks if c.kind in PER_VALUE]
    row_aggs = [F.count_if(_row_condition(c)).alias(f"_r{i}") for i, c in enumerate(row_checks)]
    if not value_checks:
        totals = df.agg(*row_aggs)
        counts = [f"_r{i}" for i in range(len(row_checks))]
        return totals.select(_report_rows(row_checks, counts))
    cols = list(dict.fromkeys(c.column for c in value_checks))
    grouped = df.groupingSets([[c] for c in cols], *cols).agg(
        F.count(F.lit(1)).alias("_n"),
        *[F.grouping(c).alias(f"_g{j}") for j, c in enumerate(cols)],
        *row_aggs,
    )
    final = [F.sum(F.when(F.col("_g0") == 0, F.col(f"_r{i}"))).alias(f"_r{i}") for i in range(len(row_checks))]
    for k, c in enumerate(value_checks):
        in_set = F.col(f"_g{cols.index(c.column)}") == 0
        if c.kind == "unique":
            bad = in_set & F.col(c.column).isNotNull() & (F.col("_n") > 1)
        else:
            bad = in_set & ~F.col(c.column).isin(list(c.values))
        final.append(F.count_if(bad).alias(f"_v{k}"))
    totals = grouped.agg(*final)
    counts = [f"_r{i}" for i in range(len(row_checks))] + [f"_v{k}" for k in range(len(value_checks))]
    return totals.select(_report_rows(row_checks + value_checks, counts))


class Watch:
    """Counts row-level checks while jobs compute their relations."""

    def __init__(self, checks: Sequence[Check]):
        self._checks = [c for c in checks if c.kind in ROW_LEVEL]
        self._seen: list[tuple[Observation, list[Check], bool]] = []

    def on(self, relation: str, df: DataFrame, written: bool = False) -> DataFrame:
        """``df`` with the checks declared for ``relation`` counted on its rows. Use the
        result in one job only. ``written``: the job writes ``df`` itself. Then a count is exact;
        rows of a relation further inside may be seen twice if an executor is lost, so there only a
        count of zero is taken and any other is left to :func:`run_checks`."""
        own = [c for c in self._checks if c.relation == relation]
        if not own:
            return df
        seen = Observation()
        self._seen.append((seen, own, written))
        return df.observe(seen, *(F.count_if(_row_condition(c)).alias(f"_r{i}") for i, c in enumerate(own)))

    def failures(self) -> dict[Check, int]:
        """The counts of all relations, whose jobs must have run."""
        out = {}
        for seen, own, written in self._seen:
            got = seen.get
            for i, c in enumerate(own):
                n = got.get(f"_r{i}") or 0
                if written or n == 0:
                    out[c] = n
        return out


def run_checks(
    spark: SparkSession,
    relations: dict[str, DataFrame],
    checks: Sequence[Check],
    store_failures_to: str | None = None,
    counted: dict[Check, int] | None = None,
) -> DataFrame:
    """One report row per check: check_name, relation, column_name, severity,
    failures (rows the check returns), status (pass, or the severity;
    ``skipped`` with NULL failures when the relation is not available).

    Checks on the same relation share one pass (see
    :func:`_fused_relation_report`); relationship checks are anti joins.
    Those in ``counted`` (from :meth:`Watch.failures`) are not run again.
    With ``store_failures_to`` the report is computed at once, and the failing
    rows of every check are written to ``<path>/<check name>`` (replaced on each
    run; empty for a check that passed, without running it again)."""
    parts: list[DataFrame] = []
    missing = [c for c in checks if c.relation not in relations or (c.parent and c.parent not in relations)]
    checks = [c for c in checks if c not in missing]
    if missing:
        parts.append(
            spark.createDataFrame(
                [(c.name, c.relation, c.column, c.severity, None) for c in missing],
                "check_name string, relation string, column_name string, severity string, failures bigint",
            )
        )
    known = {c: n for c, n in (counted or {}).items() if c in checks}
    if known:
        parts.append(
            spark.createDataFrame(
                [(c.name, c.relation, c.column, c.severity, n) for c, n in known.items()],
                "check_name string, relation string, column_name string, severity string, failures bigint",
            )
        )
    by_relation: dict[str, list[Check]] = {}
    for ch in checks:
        if ch.kind in FUSED and ch not in known:
            by_relation.setdefault(ch.relation, []).append(ch)
    for rel, chs in by_relation.items():
        parts.append(_fused_relation_report(relations[rel], chs))
    for ch in checks:
        if ch.kind not in FUSED:
            parts.append(failures_of(ch, relations).agg(F.count(F.lit(1)).alias("_c")).select(_report_rows([ch], ["_c"])))
    if not parts:
        return spark.createDataFrame([], REPORT_SCHEMA)
    while len(parts) > 1:  # in pairs: every union analyses its plan again
        parts = [a.unionByName(b) for a, b in zip(parts[::2], parts[1::2])] + parts[len(parts) // 2 * 2 :]
    report = parts[0]
    status = (
        F.when(F.col("failures").isNull(), F.lit("skipped"))
        .when(F.col("failures") == 0, F.lit("pass"))
        .otherwise(F.col("severity"))
    )
    report = report.withColumn("status", status)
    if store_failures_to:
        # one row per check: kept, so that only checks with failures run again
        rows = report.collect()
        failing = {r.check_name for r in rows if r.failures}
        for ch in checks:
            bad = failures_of(ch, relations)
            store_failures(bad if ch.name in failing else bad.where("false"), f"{store_failures_to.rstrip('/')}/{_safe(ch.name)}")
        report = spark.createDataFrame(rows, REPORT_SCHEMA)
    return report


def _safe(name: str) -> str:
    return "".join(ch if ch.isalnum() or ch in "_-." else "_" for ch in name)


def accepted_value_checks() -> CheckSuite:
    """The project's documented value domains (8 sites)."""
    regions, status = ("NORTH AMERICA", "LATAM", "EMEA", "APAC"), ("O", "F", "P")
    s = CheckSuite()
    s.add("accepted_values", "source.orders", "o_orderstatus", values=status)
    s.add("accepted_values", "stg_orders", "status_code", values=status)
    s.add("accepted_values", "stg_line_items", "return_flag", values=("R", "A", "N"))
    s.add("accepted_values", "orders_enriched", "sales_region", values=regions)
    s.add("accepted_values", "fct_orders", "status_code", values=status)
    s.add("accepted_values", "agg_revenue_by_sales_region", "sales_region", values=regions)
    s.add("accepted_values", "seed.nation_region_overrides", "sales_region", values=regions)
    s.add("accepted_values", "seed.market_segment_labels", "priority_tier", values=(1, 2, 3, 4))
    return s


def declared_checks() -> CheckSuite:
    """Every column check declared for the project: raw sources, staged
    tables, enriched views, marts, seeds and history (105 checks: 66
    not_null, 27 unique, 11 not_negative, 1 relationships). Relation names:
    ``source.<table>``, ``stg_*``, ``orders_enriched``,
    ``line_items_enriched``, the mart names, ``seed.<name>``, ``snp_*``."""
    s = CheckSuite()
    # raw sources
    s.add("unique", "source.customer", "c_custkey").add("not_null", "source.customer", ["c_custkey", "c_name", "c_nationkey"])
    s.add("unique", "source.orders", "o_orderkey").add("not_null", "source.orders", ["o_orderkey", "o_custkey", "o_orderstatus"])
    s.add("not_null", "source.lineitem", ["l_orderkey", "l_linenumber"])
    s.add("unique", "source.supplier", "s_suppkey").add("not_null", "source.supplier", "s_suppkey")
    s.add("unique", "source.part", "p_partkey").add("not_null", "source.part", "p_partkey")
    s.add("not_null", "source.partsupp", ["ps_partkey", "ps_suppkey"])
    s.add("unique", "source.nation", "n_nationkey").add("not_null", "source.nation", "n_nationkey")
    s.add("unique", "source.region", "r_regionkey").add("not_null", "source.region", "r_regionkey")
    # staged tables
    s.add("unique", "stg_customers", "customer_key").add("not_null", "stg_customers", ["customer_key", "market_segment"])
    s.add("unique", "stg_orders", "order_key").add("not_null", "stg_orders", ["order_key", "customer_key"])
    s.add("relationships", "stg_orders", "customer_key", parent="stg_customers", parent_column="customer_key")
    s.add("not_null", "stg_line_items", ["order_key", "line_number"])
    s.add("unique", "stg_suppliers", "supplier_key").add("not_null", "stg_suppliers", "supplier_key")
    s.add("unique", "stg_parts", "part_key").add("not_null", "stg_parts", "part_key")
    s.add("not_null", "stg_part_suppliers", ["part_key", "supplier_key"])
    s.add("unique", "stg_nations", ["nation_key", "nation_name"]).add("not_null", "stg_nations", ["nation_key", "nation_name"])
    s.add("unique", "stg_regions", ["region_key", "region_name"]).add("not_null", "stg_regions", ["region_key", "region_name"])
    # enriched views
    s.add("unique", "orders_enriched", "order_key")
    s.add("not_null", "orders_enriched", ["order_key", "customer_key", "order_date", "sales_region"])
    s.add("not_null", "line_items_enriched", ["order_key", "line_number"])
    # marts
    s.add("unique", "fct_orders", "order_key").add("not_null", "fct_orders", ["order_key", "order_date", "sales_region"])
    s.add("not_negative", "fct_orders", ["gross_revenue", "net_revenue"])
    s.add("unique", "fct_order_items", "order_item_key")
    s.add("not_null", "fct_order_items", ["order_item_key", "order_key", "sales_region"])
    s.add("not_negative", "fct_order_items", ["discounted_price", "net_price"])
    s.add("unique", "fct_returns", "order_item_key").add("not_null", "fct_returns", ["order_item_key", "order_key"])
    s.add("not_negative", "fct_returns", "returned_gross_amount")
    s.add("unique", "dim_customers", "customer_key").add("not_null", "dim_customers", ["customer_key", "sales_region"])
    s.add("unique", "dim_suppliers", "supplier_key").add("not_null", "dim_suppliers", ["supplier_key", "sales_region"])
    s.add("unique", "dim_parts", "part_key").add("not_null", "dim_parts", ["part_key", "supplier_count"])
    s.add("not_negative", "dim_parts", "supplier_count")
    s.add("unique", "dim_dates", "date_key").add("not_null", "dim_dates", ["date_key", "year_number"])
    for agg, key in (("agg_revenue_by_nation", "nation_name"), ("agg_revenue_by_sales_region", "sales_region")):
        s.add("not_null", agg, [key, "order_year", "order_month"])
        s.add("not_negative", agg, ["gross_revenue", "net_revenue"])
    # seeds
    s.add("unique", "seed.nation_region_overrides", "nation_name")
    s.add("not_null", "seed.nation_region_overrides", ["nation_name", "sales_region"])
    s.add("unique", "seed.fx_rates", "currency_code").add("not_null", "seed.fx_rates", ["currency_code", "usd_rate"])
    s.add("not_negative", "seed.fx_rates", "usd_rate")
    s.add("unique", "seed.market_segment_labels", "market_segment")
    s.add("not_null", "seed.market_segment_labels", ["market_segment", "priority_tier"])
    # history
    s.add("not_null", "snp_customers", ["customer_key", "scd_id"]).add("unique", "snp_customers", "scd_id")
    s.add("not_null", "snp_suppliers", ["supplier_key", "scd_id"]).add("unique", "snp_suppliers", "scd_id")
    return s
