"""Cleaning steps: each adds or replaces columns; only `drop_out_of_bounds` drops rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanstar.functions import measures as m
from gleanstar.functions.text import folded, lower_trimmed, padded_code, trimmed, upper_trimmed
from gleanstar.operators.joins import lookup_join

# Misspelt or over-specified city names and the names they stand for.
CITY_CORRECTIONS = [
    ("sao paulo sp", "sao paulo"),
    ("garulhos", "guarulhos"),
    ("mogi das cruses", "mogi das cruzes"),
    ("sando andre", "santo andre"),
    ("santo andre/sao paulo", "santo andre"),
    ("maua/sao paulo", "maua"),
    ("sao bernardo do capo", "sao bernardo do campo"),
    ("santa barbara d oeste", "santa barbara d'oeste"),
    ("portoferreira", "porto ferreira"),
    ("scao jose do rio pardo", "sao jose do rio pardo"),
    ("robeirao preto", "ribeirao preto"),
    ("ribeirao preto / sao paulo", "ribeirao preto"),
    ("riberao preto", "ribeirao preto"),
    ("auriflama/sp", "auriflama"),
    ("rio de janeiro, rio de janeiro, brasil", "rio de janeiro"),
    ("belo horizont", "belo horizonte"),
    ("cascavael", "cascavel"),
    ("floranopolis", "florianopolis"),
    ("balenario camboriu", "balneario camboriu"),
    ("lages - sc", "lages"),
    ("sao miguel do oeste", "sao miguel d'oeste"),
    ("vendas@creditparts.com.br", "maringa"),
    ("parana", "maringa"),
    ("04482255", "rio de janeiro"),
]
# Entries of the city column that are no city.
WRONG_CITIES = ["sp", "minas gerais", "santa catarina"]
# Latitude and longitude box of the country.
LATITUDE = (-34, 6)
LONGITUDE = (-75, -33)
# Fixed value: shipping limits from this day on are implausible.
SHIPPING_CUTOFF = "2019-01-01"


def standardize_text(df: DataFrame, lower: Sequence[str] = (), upper: Sequence[str] = ()) -> DataFrame:
    return df.withColumns({c: lower_trimmed(c) for c in lower} | {c: upper_trimmed(c) for c in upper})


def trim_ids(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Trim text ids; ids of other types have nothing to trim and stay as they are."""
    types = dict(df.dtypes)
    return df.withColumns({c: trimmed(c) for c in columns if types[c] == "string"})


def pad_code(df: DataFrame, column: str, width: int = 5) -> DataFrame:
    return df.withColumn(column, padded_code(column, width))


def typed_timestamps(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Strict cast: an unparseable value fails the job rather than turning NULL."""
    return df.withColumns({c: F.col(c).cast("timestamp") for c in columns})


def null_preserving_trim(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.withColumns({c: trimmed(c) for c in columns})


def placeholder_null(df: DataFrame, column: str, flag: str, placeholder: str = "unknown") -> DataFrame:
    return df.withColumns({flag: F.col(column).isNull(), column: F.coalesce(F.col(column), F.lit(placeholder))})


def impute_group_median(
    df: DataFrame, group: str, column: str, flag: str, accuracy: int = m.ACCURACY
) -> DataFrame:
    """Replace zeros by the median of the positive values of the row's own group.

    A row without a group, or whose group has no positive value, keeps its zero; the
    flag marks every zero and is NULL for a NULL value. Only rows to impute carry a
    join key, all others are spread evenly through the join.
    """
    medians = (
        df.filter((F.col(column) > 0) & F.col(group).isNotNull())
        .groupBy(F.col(group).alias("_group"))
        .agg(F.percentile_approx(column, 0.5, accuracy).alias("_median"))
    )
    marked = df.withColumn(flag, F.col(column) == 0).withColumn("_group", F.when(F.col(flag), F.col(group)))
    joined = lookup_join(marked, medians, "_group", "left")
    value = F.when(F.col(flag), F.coalesce(F.col("_median"), F.col(column))).otherwise(F.col(column))
    return joined.withColumn(column, value).select(*df.columns, flag)


def lookup_correction(
    df: DataFrame, column: str, flag: str, corrections: Sequence[tuple[str, str]] = tuple(CITY_CORRECTIONS)
) -> DataFrame:
    """Replace listed values; the list is a literal relation, so broadcasting it is safe."""
    table = df.sparkSession.createDataFrame(list(corrections), "_wrong string, _right string")
    joined = df.join(F.broadcast(table), F.col(column) == F.col("_wrong"), "left")
    return joined.withColumns(
        {flag: F.col("_right").isNotNull(), column: F.coalesce(F.col("_right"), F.col(column))}
    ).drop("_wrong", "_right")


def wrong_attribute_flag(
    df: DataFrame, column: str, flag: str, values: Sequence[str] = tuple(WRONG_CITIES)
) -> DataFrame:
    return df.withColumn(flag, F.col(column).isin(*values))


def drop_out_of_bounds(df: DataFrame, bounds: Mapping[str, tuple[float, float]]) -> DataFrame:
    """Keep rows inside the box; NULL coordinates are dropped. Reaches the scan as a filter."""
    for c, (lo, hi) in bounds.items():
        df = df.filter(F.col(c).between(lo, hi))
    return df


def fold_diacritics(df: DataFrame, columns: Sequence[str], lower_first: bool = True) -> DataFrame:
    return df.withColumns({c: folded(c, lower_first) for c in columns})


def multi_value_flag(
    df: DataFrame, key: str, columns: Sequence[str], flag: str, missing: Column | None = None
) -> DataFrame:
    """Flag every row of a key that has more than one distinct value in any column.

    Minimum and maximum per key combine before the shuffle and the flag is joined
    back with hot keys spread out; a window would sort a whole key in one task. Rows
    with a NULL key get `missing` (default NULL).
    """
    per_key = df.filter(F.col(key).isNotNull()).groupBy(key).agg(m.any_true(m.varies(c) for c in columns).alias(flag))
    out = lookup_join(df, per_key, key, "left")
    if missing is not None:
        out = out.withColumn(flag, F.coalesce(F.col(flag), missing))
    return out.select(*df.columns, flag)


def ambiguity_flag(df: DataFrame, key: str, column: str, flag: str) -> DataFrame:
    return multi_value_flag(df, key, [column], flag, missing=F.lit(False))


def missing_sequence_start(df: DataFrame, key: str, seq: str, flag: str) -> DataFrame:
    """The smallest sequence number of the row's key exceeds 1 (NULL keys form one group)."""
    first = df.groupBy(key).agg((F.min(seq) > 1).alias(flag))
    out = lookup_join(df, first, key, "left", null_safe=True)
    return out.select(*df.columns, flag)


def lifecycle_flags(
    df: DataFrame,
    status: str = "order_status",
    approved: str = "order_approved_at",
    carrier: str = "order_delivered_carrier_date",
    delivered: str = "order_delivered_customer_date",
) -> DataFrame:
    """Eight flags on contradictory or incomplete order lifecycles; three-valued."""
    has = {c: F.col(c).isNotNull() for c in (approved, carrier, delivered)}
    is_delivered = F.col(status) == "delivered"
    undelivered = is_delivered & ~has[delivered]
    complete_before = has[approved] & has[carrier]
    return df.withColumns(
        {
            "is_expected_null_delivery": (F.col(status) != "delivered") & ~has[delivered],
            "is_delivered_missing_final_date_only": undelivered & complete_before,
            "is_delivered_missing_multiple_dates_anomaly": undelivered & ~complete_before,
            "is_delivered_missing_approval_anomaly": is_delivered & ~has[approved],
            "is_delivered_missing_carrier_anomaly": is_delivered & ~has[carrier],
            "is_canceled_with_delivery_date_anomaly": (F.col(status) == "canceled") & has[delivered],
            "is_delivery_before_carrier_anomaly": F.coalesce(F.col(delivered) < F.col(carrier), F.lit(False)),
            "is_carrier_before_approval_anomaly": F.coalesce(F.col(carrier) < F.col(approved), F.lit(False)),
        }
    )


def payment_flags(
    df: DataFrame,
    kind: str = "payment_type",
    value: str = "payment_value",
    installments: str = "payment_installments",
    undefined: str = "not_defined",
) -> DataFrame:
    return df.withColumns(
        {
            "is_undefined_payment_type": F.col(kind) == undefined,
            "is_zero_payment_value": F.col(value) == 0,
            "is_zero_installments": F.col(installments) == 0,
        }
    )


def item_flags(
    df: DataFrame,
    freight: str = "freight_value",
    limit: str = "shipping_limit_date",
    cutoff: str = SHIPPING_CUTOFF,
) -> DataFrame:
    return df.withColumns(
        {
            "is_zero_freight": F.col(freight) == 0,
            "is_shipping_date_anomaly": F.col(limit) >= F.to_timestamp(F.lit(cutoff)),
        }
    )


def rename_columns(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(names))
