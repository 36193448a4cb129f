"""Source extracts. Each is ``select`` + ``filter`` on a table or DataFrame, so
the predicates and the column list reach the parquet scan (PushedFilters /
ReadSchema) instead of being applied after a full read."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ratecell import spec
from ratecell.operators.filters import in_jurisdiction


# The latest as-of date that the source has (found by a scan of that column; name the date to save it).
LATEST = "latest"


def _dated(src: DataFrame, as_of: str | None) -> list[Column]:
    if as_of is None or "dat_as_of_dt" not in src.columns:
        return []
    if as_of == LATEST:
        as_of = src.agg(F.max("dat_as_of_dt")).first()[0]
    return [F.col("dat_as_of_dt") == F.lit(as_of)]


def extract_trx(src: DataFrame, columns: Sequence[str] | None, province: str | None,
                region: str = "AP", products: Iterable[str] = ("ppa",),
                as_of: str | None = LATEST, year_type: str | None = spec.YEAR_TYPE) -> DataFrame:
    """TRX extract: chosen columns; region, as-of date, product IN, year type,
    non-commercial, onset code present; then the province. A source with as-of dates is cut to one
    (``None`` keeps all: the same policies then repeat), one with year types to ``year_type``."""
    d = src
    conds = [F.col("pol_region_cd") == F.lit(region),
             F.col("veh_product_cd").isin(list(products)),
             F.col("pol_commercial_in") == F.lit(0),
             F.col("trx_offset_onset_cd").isNotNull()]
    conds += _dated(src, as_of)
    if year_type is not None and "dat_year_type_tx" in src.columns:
        conds.append(F.col("dat_year_type_tx") == F.lit(year_type))
    for c in conds:
        d = d.filter(c)
    if columns is not None:
        d = d.select(*columns)
    return in_jurisdiction(d, province)


def extract_inforce(src: DataFrame, province: str | Iterable[str] | None, region: str = "AP",
                    products: Iterable[str] = ("ppa", "motor_home"),
                    as_of: str | None = LATEST) -> DataFrame:
    """Inforce extract: every column; region, as-of (as in ``extract_trx``), ppa + motor homes,
    non-commercial, province IN."""
    d = (src.filter(F.col("pol_region_cd") == F.lit(region))
         .filter(F.col("veh_product_cd").isin(list(products)))
         .filter(F.col("pol_commercial_in") == F.lit(0)))
    for c in _dated(src, as_of):
        d = d.filter(c)
    if isinstance(province, str):
        province = [province]
    return in_jurisdiction(d, province)


def extract_loss_cost(src: DataFrame, region: str = "AP",
                      products: Iterable[str] = ("ppa", "motor_home"),
                      columns: Sequence[str] = ()) -> DataFrame:
    """Loss-cost scan: key + predicted loss-cost columns, region and product filter."""
    d = (src.filter(F.col("pol_region_cd") == F.lit(region))
         .filter(F.col("veh_product_cd").isin(list(products))))
    return d.select(*columns) if columns else d


def read_helper(spark: SparkSession, path: str, delimiter: str = ",") -> DataFrame:
    """A helper CSV with a header row."""
    return spark.read.options(header=True, delimiter=delimiter).csv(path)


def config_columns(helper: DataFrame, column: str = "var_name") -> list[str]:
    """Column list held in a helper table, in its order (it lists columns, not data)."""
    return [r[0] for r in helper.select(column).collect()]


def register(df: DataFrame, name: str) -> DataFrame:
    """Temp view so SQL text can refer to the frame."""
    df.createOrReplaceTempView(name)
    return df
