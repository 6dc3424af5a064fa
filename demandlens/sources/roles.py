"""Typed role tables.

The jobs read eight tables by role. Each role has one declared ``StructType``; ``conform``
turns a raw frame (dates as ``yyyyMMdd`` text, blank-padded codes, loose numeric types, source
headers) into that schema once, at load, so no query relies on implicit coercion.

Keys are text, as stored at the source: ``007`` and ``7`` are two products. Measures are
``DECIMAL(18,3)``: sums are exact, so a rounded report cell does not depend on the order in
which rows arrive.

A value that cannot be read as its field's type becomes NULL. Jobs then filter such rows away, so
they are counted where they are made: ``load(..., raw=True, observe=True)`` attaches counters to
the frames, which the pass that writes them (a batch's staging) fills without a second one.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_S, _D, _I = T.StringType(), T.DateType(), T.IntegerType()
MEASURE = T.DecimalType(18, 3)


def _schema(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


PRODUCT_COLUMNS = ("manager", "name", "node_2", "node_2_name", "node_3", "node_3_name",
                   "node_4", "node_4_name", "node_5", "node_5_name")

SCHEMAS: dict[str, T.StructType] = {
    # snapshot_date x forecast_date x material x store x diag_id (x offer)
    "forecast": _schema(("material", _S), ("store", _S), ("forecast_date", _D), ("snapshot_date", _D),
                        ("diag_id", _S), ("ofr_id", _S), ("promo_flag", _I),
                        ("system_forecast", MEASURE), ("s4_adjustment", MEASURE),
                        ("car_adjustment", MEASURE), ("approved_forecast", MEASURE)),
    # day x material x plant
    "sales_stock": _schema(("caldate", _D), ("material", _S), ("plant", _S), ("ispromo", _I),
                           ("dismm", _S), ("sc_quantity", MEASURE)),
    "product_dict": _schema(("material", _S), *((c, _S) for c in PRODUCT_COLUMNS)),
    "assortment": _schema(("plu", _S), ("zavod", _S), ("az_type", _S)),
    "store_dict": _schema(("number", _S), ("type_cf", _S)),
    # day x plu x zavod
    "daily_sales": _schema(("calc_date", _D), ("plu", _S), ("zavod", _S), ("sc_quantity", MEASURE),
                           ("sc_quantity_not_anypromo", MEASURE)),
    "plu_cat": _schema(("plu", _S), ("km", _S), ("ui_5", _S), ("ui_5_name", _S)),
    "user_login": _schema(("category_manager", _S), ("user", _S)),
}

# --- fixed values: headers of the source tables that differ from the role's field names -------
SOURCE_COLUMNS: dict[str, dict[str, str]] = {
    "product_dict": {
        "Материал": "material", "Категорийный_менеджм": "manager", "Название": "name",
        "Узел_2": "node_2", "Описание_2": "node_2_name", "Узел_3": "node_3",
        "Описание_3": "node_3_name", "Узел_4": "node_4", "Описание_4": "node_4_name",
        "Узел_5": "node_5", "Описание_5": "node_5_name",
    },
    "store_dict": {"Номер": "number", "Тип_CF": "type_cf"},
}
# ------------------------------------------------------------------------------------------------

# Codes and keys lose trailing blanks ('' = main line / no offer carries meaning).
_TRIMMED = {"forecast": ("material", "diag_id", "ofr_id", "store"),
            "sales_stock": ("material", "plant", "dismm"), "product_dict": ("material",),
            "assortment": ("plu", "zavod", "az_type"), "store_dict": ("number", "type_cf"),
            "daily_sales": ("plu", "zavod"), "plu_cat": ("plu", "km"),
            "user_login": ("category_manager",)}


def _as_date(c: Column, source: T.DataType) -> Column:
    if isinstance(source, T.DateType):
        return c
    if isinstance(source, (T.TimestampType, T.TimestampNTZType)):
        return c.cast("date")
    # yyyyMMdd text or integer; an impossible date (20260230) becomes NULL, not an error
    return F.try_to_date(c.cast("string"), "yyyyMMdd")


def _sources(df: DataFrame, role: str, columns: Mapping[str, str] | None,
             optional: Iterable[str]) -> dict[str, T.StructField | None]:
    """Role field -> source column; None for an absent column that is listed as optional.

    ``columns`` (source name -> field) comes before the documented headers, these before a
    name equal to the field's. Names match without regard to case.
    """
    fields = set(SCHEMAS[role].fieldNames())
    named = {**SOURCE_COLUMNS.get(role, {}), **(columns or {})}
    wrong = sorted(set(named.values()) - fields)
    if wrong:
        raise ValueError(f"role {role} has no field {', '.join(wrong)}")
    by_header = {k.lower(): v for k, v in named.items()}
    found: dict[str, T.StructField | None] = {}
    for f in df.schema.fields:
        field = by_header.get(f.name.lower(), f.name.lower())
        if field in fields:
            if field in found:
                raise ValueError(f"role {role}: columns {found[field].name} and {f.name} both "
                                 f"give {field}")
            found[field] = f
    optional = set(optional)
    missing = [n for n in SCHEMAS[role].fieldNames() if n not in found and n not in optional]
    if missing:
        raise ValueError(f"role {role}: required column {', '.join(missing)} is missing; "
                         f"the table has {', '.join(df.columns)}")
    return {n: found.get(n) for n in SCHEMAS[role].fieldNames()}


class Observed:
    """Values of a role that ``conform`` rejected, by field; known once the frame has been written."""

    def __init__(self):
        self.observation = Observation()

    def counts(self) -> dict[str, int]:
        """``rejected_<field>`` -> number of values."""
        return {k: int(v or 0) for k, v in self.observation.get.items()}


class Roles(dict):
    """Role -> frame, as loaded; ``observed`` has the counters of roles that carry some."""

    def __init__(self, *args, **kwargs):
        super().__init__(*args, **kwargs)
        self.observed: dict[str, Observed] = {}


def _is_given(c: Column, source: T.DataType) -> Column:
    """A value that means something: neither NULL nor blank text."""
    return F.trim(c) != "" if isinstance(source, T.StringType) else c.isNotNull()


def conform(df: DataFrame, role: str, columns: Mapping[str, str] | None = None,
            optional: Iterable[str] = (), observed: Observed | None = None) -> DataFrame:
    """Project ``df`` onto the role's schema: map headers, parse dates, rtrim codes, cast.

    A missing column raises, unless it is named in ``optional``; then it is NULL. A value that
    does not fit its type is NULL as well, and counted by ``observed``.
    """
    trimmed = _TRIMMED.get(role, ())
    cols, rejected = [], []
    for field, src in zip(SCHEMAS[role].fields, _sources(df, role, columns, optional).values()):
        if src is None:
            cols.append(F.lit(None).cast(field.dataType).alias(field.name))
            continue
        raw = F.col(f"`{src.name}`")
        if isinstance(field.dataType, T.DateType):
            c = _as_date(raw, src.dataType)
        elif isinstance(field.dataType, T.StringType):
            c = raw.cast(field.dataType)
            if field.name in trimmed:
                c = F.rtrim(c)
        else:
            c = raw if src.dataType == field.dataType else raw.try_cast(field.dataType)
        if src.dataType != field.dataType and not isinstance(field.dataType, T.StringType):
            rejected.append(F.count_if(_is_given(raw, src.dataType) & c.isNull())
                            .alias(f"rejected_{field.name}"))
        cols.append(c.alias(field.name))
    if observed is not None and rejected:
        df = df.observe(observed.observation, *rejected)
    return df.select(*cols)


def project(df: DataFrame, role: str, columns: Mapping[str, str] | None = None,
            optional: Iterable[str] = ()) -> DataFrame:
    """Select the role's columns with their declared types.

    For a table already in the role schema the casts are no-ops that Catalyst removes.
    """
    found = _sources(df, role, columns, optional)
    return df.select(*[(F.lit(None) if found[f.name] is None else F.col(f"`{found[f.name].name}`"))
                       .cast(f.dataType).alias(f.name) for f in SCHEMAS[role].fields])


def load(spark: SparkSession, paths: Mapping[str, str], fmt: str = "parquet", raw: bool = False,
         columns: Mapping[str, Mapping[str, str]] | None = None,
         optional: Mapping[str, Iterable[str]] | None = None, observe: bool = False) -> Roles:
    """Read each role from ``paths`` (role -> path or table name).

    A value containing ``/`` (or a URI) is a path; any other value is a catalog table name,
    one to three parts (``spark.table``). Both keep partition pruning on ``snapshot_date``
    when the forecast table is partitioned by it. With ``raw=True`` the frames go through
    ``conform``; otherwise they are projected onto the declared schema, which keeps a typed
    table's bucketing usable. ``columns`` (role -> source name -> field) adds to
    ``SOURCE_COLUMNS``; ``optional`` (role -> fields) lists columns that may be absent.
    ``observe`` counts what ``conform`` rejects; it is meant for a batch that stages its roles,
    since counters keep filters above them from the scan.
    """
    out = Roles()
    for role, where in paths.items():
        df = spark.read.format(fmt).load(where) if "/" in where else spark.table(where)
        named, absent = (columns or {}).get(role), (optional or {}).get(role, ())
        if not raw:
            out[role] = project(df, role, named, absent)
            continue
        seen = Observed() if observe and _can_reject(df, role, named, absent) else None
        out[role] = conform(df, role, named, absent, seen)
        if seen:
            out.observed[role] = seen
    return out


def _can_reject(df: DataFrame, role: str, columns: Mapping[str, str] | None,
                optional: Iterable[str]) -> bool:
    """Whether a field has another type in the source than in the role, and none that takes all."""
    found = _sources(df, role, columns, optional)
    return any(src is not None and src.dataType != field.dataType
               and not isinstance(field.dataType, T.StringType)
               for field, src in ((f, found[f.name]) for f in SCHEMAS[role].fields))


def load_jdbc(spark: SparkSession, url: str, tables: Mapping[str, str],
              partitioning: Mapping[str, tuple[str, object, object, int]] | None = None,
              properties: Mapping[str, str] | None = None,
              columns: Mapping[str, Mapping[str, str]] | None = None,
              optional: Mapping[str, Iterable[str]] | None = None) -> dict[str, DataFrame]:
    """Read roles from a SQL warehouse through Spark's JDBC source, then ``conform`` them.

    ``tables`` maps role -> table name (three-part names allowed, e.g.
    ``warehouse.sales.forecast``). ``partitioning`` maps role -> (column, lower, upper,
    num_partitions), so a large role is read by many tasks in parallel ranges instead of one
    connection. Filters and projections written on the returned frames are pushed into the
    database query by Spark. Untested: it needs a database, and none is started here.
    """
    out = {}
    for role, table in tables.items():
        reader = spark.read.format("jdbc").option("url", url).option("dbtable", table)
        for k, v in (properties or {}).items():
            reader = reader.option(k, v)
        if partitioning and role in partitioning:
            column, lower, upper, n = partitioning[role]
            reader = (reader.option("partitionColumn", column).option("lowerBound", str(lower))
                      .option("upperBound", str(upper)).option("numPartitions", str(n)))
        out[role] = conform(reader.load(), role, (columns or {}).get(role),
                            (optional or {}).get(role, ()))
    return out


def assert_unique(df: DataFrame, keys: Iterable[str]) -> DataFrame:
    """Return the key values that occur more than once (empty when ``keys`` is a key).

    Dimension joins fan out silently on duplicate keys; run this on a dimension before a
    batch. It is one aggregation, so it scales with the table.
    """
    keys = list(keys)
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"))
              .where(F.col("n_rows") > 1))
