"""Reading raw tables by logical name from a pinned root folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# The eight raw tables, in the default landing order.
SOURCE_TABLES = ("customer", "orders", "lineitem", "supplier", "part", "partsupp", "nation", "region")


CATALOG = "catalog:"


def source_path(root: str, name: str) -> str:
    return f"{root.rstrip('/')}/{name}.parquet"


def read_source(spark: SparkSession, root: str, name: str, schema=None) -> DataFrame:
    """Lazy scan of ``<root>/<name>.parquet`` (a file or a folder of part
    files), with an explicit ``schema`` if given, or of the table ``name`` in
    the catalog's database when the root is ``catalog:<database>``. A landed table is
    read in its current version (see :mod:`sparkmarts.sources.versions`).

    Column pruning and filter pushdown reach the scan through the staging
    projections, so nothing here reads more than the query needs. The scan's
    own partitions are kept: joins and aggregations shuffle by their keys, where
    AQE can split a hot one."""
    if root.startswith(CATALOG):
        return spark.table(f"{root.removeprefix(CATALOG)}.{name}")
    from sparkmarts.sources.versions import read_table

    return read_table(spark, source_path(root, name), schema)


def hadoop_path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs, hpath


def source_exists(spark: SparkSession, root: str, name: str) -> bool:
    if root.startswith(CATALOG):
        return spark.catalog.tableExists(f"{root.removeprefix(CATALOG)}.{name}")
    return table_exists(spark, source_path(root, name))


def table_exists(spark: SparkSession, path: str) -> bool:
    """True when ``path`` exists in the (possibly distributed) file system."""
    fs, hpath = hadoop_path(spark, path)
    return bool(fs.exists(hpath))


def delete_path(spark: SparkSession, path: str) -> None:
    fs, hpath = hadoop_path(spark, path)
    if fs.exists(hpath):
        fs.delete(hpath, True)


def list_partition_dirs(spark: SparkSession, path: str) -> list[str]:
    """Names of the first-level partition folders (``col=value``) under ``path``."""
    fs, hpath = hadoop_path(spark, path)
    if not fs.exists(hpath):
        return []
    out = []
    for st in fs.listStatus(hpath):
        name = st.getPath().getName()
        if st.isDirectory() and "=" in name and not name.startswith((".", "_")):
            out.append(name)
    return sorted(out)


def latest_partition(spark: SparkSession, path: str, columns: list[str]) -> tuple | None:
    """The greatest partition value tuple under ``path`` for nested partition
    ``columns`` (e.g. order_year/order_month), from the folder listing only;
    integers compare numerically; of the current version if the table has
    versions. None when there is no such partition."""
    from sparkmarts.sources.versions import current

    version = current(spark, path)
    if version is not None:
        number = lambda v: int(v) if v.lstrip("-").isdigit() else v
        found = [tuple(x.split("=", 1)[1] for x in part.split("/")) for part in version.parts if part]
        found = [tuple(number(v) for v in x) for x in found if "__HIVE_DEFAULT_PARTITION__" not in x]
        return max(found, default=None)
    values: list = []
    base = path.rstrip("/")
    for col in columns:
        names = [n for n in list_partition_dirs(spark, base) if n.startswith(f"{col}=")]
        vals = [n.split("=", 1)[1] for n in names]
        vals = [v for v in vals if v != "__HIVE_DEFAULT_PARTITION__"]
        if not vals:
            return None
        best = max(vals, key=lambda v: (0, int(v)) if v.lstrip("-").isdigit() else (1, v))
        values.append(int(best) if best.lstrip("-").isdigit() else best)
        base = f"{base}/{col}={best}"
    return tuple(values)
