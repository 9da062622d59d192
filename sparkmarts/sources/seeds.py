"""Seeds: three small reference tables with fixed column types.

``load_seed(spark, name)`` returns the built-in rows; pass ``path`` to read an
edited CSV with a header instead (the declared types are applied either way)."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

SEED_SCHEMAS = {
    "nation_region_overrides": "nation_name string, display_name string, sales_region string",
    "fx_rates": "currency_code string, currency_name string, usd_rate decimal(12,6)",
    "market_segment_labels": "market_segment string, display_label string, industry_group string, priority_tier int",
}
SEED_NAMES = tuple(SEED_SCHEMAS)

# ---------------------------------------------------------------------------
# FIXED VALUES: seed rows that must equal the reference data exactly.
# ---------------------------------------------------------------------------
NATION_REGION_OVERRIDES = [
    ("ALGERIA", "Algeria", "EMEA"),
    ("ARGENTINA", "Argentina", "LATAM"),
    ("BRAZIL", "Brazil", "LATAM"),
    ("CANADA", "Canada", "NORTH AMERICA"),
    ("CHINA", "China", "APAC"),
    ("EGYPT", "Egypt", "EMEA"),
    ("ETHIOPIA", "Ethiopia", "EMEA"),
    ("FRANCE", "France", "EMEA"),
    ("GERMANY", "Germany", "EMEA"),
    ("INDIA", "India", "APAC"),
    ("INDONESIA", "Indonesia", "APAC"),
    ("IRAN", "Iran", "EMEA"),
    ("IRAQ", "Iraq", "EMEA"),
    ("JAPAN", "Japan", "APAC"),
    ("JORDAN", "Jordan", "EMEA"),
    ("KENYA", "Kenya", "EMEA"),
    ("MOROCCO", "Morocco", "EMEA"),
    ("MOZAMBIQUE", "Mozambique", "EMEA"),
    ("PERU", "Peru", "LATAM"),
    ("ROMANIA", "Romania", "EMEA"),
    ("RUSSIA", "Russia", "EMEA"),
    ("SAUDI ARABIA", "Saudi Arabia", "EMEA"),
    ("UNITED KINGDOM", "United Kingdom", "EMEA"),
    ("UNITED STATES", "United States", "NORTH AMERICA"),
    ("VIETNAM", "Vietnam", "APAC"),
]
FX_RATES = [
    ("USD", "US Dollar", "1.000"),
    ("EUR", "Euro", "1.080"),
    ("GBP", "British Pound", "1.260"),
    ("JPY", "Japanese Yen", "0.0067"),
    ("CNY", "Chinese Yuan", "0.140"),
    ("BRL", "Brazilian Real", "0.200"),
    ("INR", "Indian Rupee", "0.012"),
    ("RUB", "Russian Ruble", "0.011"),
    ("CAD", "Canadian Dollar", "0.740"),
    ("ARS", "Argentine Peso", "0.0011"),
    ("SAR", "Saudi Riyal", "0.270"),
]
MARKET_SEGMENT_LABELS = [
    ("AUTOMOBILE", "Automobile", "Industrial", 2),
    ("BUILDING", "Building & Construction", "Industrial", 3),
    ("FURNITURE", "Furniture", "Consumer", 4),
    ("HOUSEHOLD", "Household Goods", "Consumer", 4),
    ("MACHINERY", "Heavy Machinery", "Industrial", 1),
]
# ---------------------------------------------------------------------------


def _rows(name: str) -> list[tuple]:
    if name == "nation_region_overrides":
        return NATION_REGION_OVERRIDES
    if name == "fx_rates":
        return [(c, n, Decimal(r)) for c, n, r in FX_RATES]
    if name == "market_segment_labels":
        return MARKET_SEGMENT_LABELS
    raise ValueError(f"unknown seed {name!r}; known: {', '.join(SEED_NAMES)}")


def _literal(v) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, bool):
        return "TRUE" if v else "FALSE"
    if isinstance(v, (int, Decimal)):
        return str(v)
    if isinstance(v, float):
        return repr(v) + "D"
    text = str(v).replace("\\", "\\\\").replace("'", "\\'")
    return f"'{text}'"


def constant_table(spark: SparkSession, rows: list[tuple], ddl: str) -> DataFrame:
    """A small constant table as an inline VALUES relation.

    Unlike ``createDataFrame`` (an RDD scan without statistics), the planner
    knows the exact size of a VALUES relation, so joins against it are
    broadcast automatically and no size-check job is needed."""
    schema = StructType.fromDDL(ddl)
    fields = [(f.name, f.dataType.simpleString()) for f in schema.fields]
    names = [n for n, _ in fields]
    if not rows:
        return spark.createDataFrame([], ddl)
    values = ", ".join("(" + ", ".join(_literal(v) for v in r) + ")" for r in rows)
    cols = ", ".join(f"CAST(c{i} AS {t}) AS `{n}`" for i, (n, t) in enumerate(fields))
    aliases = ", ".join(f"c{i}" for i in range(len(names)))
    return spark.sql(f"SELECT {cols} FROM VALUES {values} AS t({aliases})")


def load_seed(spark: SparkSession, name: str, path: str | None = None) -> DataFrame:
    if name not in SEED_SCHEMAS:
        raise ValueError(f"unknown seed {name!r}; known: {', '.join(SEED_NAMES)}")
    if path is not None:
        return spark.read.schema(SEED_SCHEMAS[name]).option("header", True).csv(path)
    return constant_table(spark, _rows(name), SEED_SCHEMAS[name])
