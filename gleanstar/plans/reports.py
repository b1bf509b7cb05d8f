"""The full list of profiling, audit and validation statements over the nine tables.

Each function returns {statement id: callable -> DataFrame}; ids are those of the
DataFrame is used.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from gleanstar.functions import measures as m
from gleanstar.functions import text as tx
from gleanstar.functions import timeparts as tp
from gleanstar.operators import audit as a
from gleanstar.operators import clean as k
from gleanstar.operators import profile as p
from gleanstar.operators import register as rg
from gleanstar.operators import serve as g
from gleanstar.operators import validate as v
from gleanstar.operators.joins import lookup_join
from gleanstar.plans import cleaning, star
from gleanstar.session import stage

Tables = Mapping[str, DataFrame]
Report = dict[str, Callable[[], DataFrame]]

PURCHASE = "order_purchase_timestamp"
APPROVED = "order_approved_at"
CARRIER = "order_delivered_carrier_date"
DELIVERED = "order_delivered_customer_date"
ESTIMATED = "order_estimated_delivery_date"
SHIP_LIMIT = "shipping_limit_date"
FACT = "fact_order_item_fulfillment"

# The order lifecycle states and the federal states.
ORDER_STATES = ["delivered", "shipped", "canceled", "unavailable", "invoiced", "processing", "created", "approved"]
FEDERAL_STATES = [
    "AC", "AL", "AP", "AM", "BA", "CE", "DF", "ES", "GO", "MA", "MT", "MS", "MG",
    "PA", "PB", "PR", "PE", "PI", "RJ", "RN", "RS", "RO", "RR", "SC", "SP", "SE", "TO",
]


@dataclass(frozen=True)
class Focus:
    """What the single-case statements look at (fixed values of the original data set)."""

    anomalous_seller: str = "7a241947449cc45dbfda4f9d0798d9d0"
    joined_seller: str = "ceb7b4fb9401cd378de7886317ad1b47"
    listed_seller: str = "47efca563408aae19bb7206c2d969ea9"
    order: str = "a4431cbd79dbddaae7988ce6091cbc3c"
    city: str = "portoferreira"
    states: tuple[str, str] = ("RJ", "PI")
    median_category: str = "cama_mesa_banho"
    compared_category: str = "cool_stuff"
    compared_pattern: str = "%cool%stuff%"
    untranslated: tuple[str, ...] = ("pc_gamer", "portateis_cozinha_e_preparadores_de_alimentos")
    late_limit: str = "2018-10-17"
    cutoff: str = k.SHIPPING_CUTOFF
    month: str = "2018-10"
    approval_hours: int = 4509
    shipping_hours: tuple[int, int] = (3018, -4109)
    delivery_days: tuple[int, int] = (-16, 205)
    as_of: date | None = None


def _ts(text: str) -> Column:
    return F.to_timestamp(F.lit(text))


def _gt_null(df: DataFrame, known: str, d: Column, test: Callable[[Column], Column]) -> DataFrame:
    return p.inspect_rows(df, F.col(known).isNotNull() & test(d))


def _side_by_side(**counts: DataFrame) -> DataFrame:
    """One row out of several one-value frames."""
    (first, frame), *rest = counts.items()
    return frame.toDF(first).select(first, *[f.scalar().alias(n) for n, f in rest])


def orders_profile(raw: Tables, focus: Focus = Focus()) -> Report:
    o = raw["orders"]
    approval = tp.elapsed(APPROVED, PURCHASE, "hour")
    shipping = tp.elapsed(CARRIER, APPROVED, "hour")
    delivery = tp.elapsed(DELIVERED, CARRIER, "day")
    early_delivery = F.col(DELIVERED) < F.col(CARRIER)
    early_carrier = F.col(CARRIER) < F.col(APPROVED)
    status = F.col("order_status")
    stamps = ["order_status", PURCHASE, APPROVED, CARRIER, DELIVERED, ESTIMATED]
    return {
        "PO.1": lambda: p.table_profile(o, ["order_id"], ["order_id", "customer_id", *stamps]),
        "PO.2": lambda: p.filtered_group_count(o, F.col(APPROVED).isNull(), "order_status"),
        "PO.3": lambda: p.filtered_group_count(o, F.col(CARRIER).isNull(), "order_status"),
        "PO.4": lambda: p.filtered_group_count(o, F.col(DELIVERED).isNull(), "order_status"),
        "PO.5": lambda: p.null_rates(o, [APPROVED, CARRIER, DELIVERED]),
        "PO.6": lambda: p.freq_distribution(o, "order_status"),
        "PO.7": lambda: p.null_by_group(o, "order_status", DELIVERED),
        "PO.8": lambda: p.inspect_rows(o, (status == "canceled") & F.col(DELIVERED).isNotNull()),
        "PO.9": lambda: p.inspect_rows(o, (status == "delivered") & F.col(DELIVERED).isNull()),
        "PO.10": lambda: p.value_range(o, [PURCHASE], {"null_purchase": m.null_count(PURCHASE)}),
        "PO.11": lambda: p.temporal_order_violations(
            o,
            {
                "approved_before_purchase": (PURCHASE, APPROVED),
                "delivered_before_purchase": (PURCHASE, DELIVERED),
                "delivered_before_carrier": (CARRIER, DELIVERED),
                "delivered_before_approved": (APPROVED, CARRIER),
            },
        ),
        "PO.12": lambda: p.inspect_rows(o, early_delivery),
        "PO.13": lambda: p.inspect_rows(o, early_carrier),
        "PO.14": lambda: p.period_volume(o, PURCHASE, early_delivery, by="parts"),
        "PO.15": lambda: p.duration_histogram(o, CARRIER, APPROVED, "hour", early_carrier),
        "PO.16": lambda: p.period_volume(o, PURCHASE),
        "PO.17": lambda: p.parse_audit(o, PURCHASE),
        "PO.18": lambda: p.duration_distribution(o, PURCHASE, APPROVED, "hour"),
        "PO.19": lambda: _gt_null(o, APPROVED, approval, lambda d: d == focus.approval_hours),
        "PO.20": lambda: p.duration_distribution(o, APPROVED, CARRIER, "hour"),
        "PO.21": lambda: _gt_null(o, APPROVED, shipping, lambda d: d == focus.shipping_hours[0]),
        "PO.22": lambda: _gt_null(o, APPROVED, shipping, lambda d: d == focus.shipping_hours[1]),
        "PO.23": lambda: _gt_null(o, APPROVED, shipping, lambda d: d < 0),
        "PO.24": lambda: p.duration_distribution(o, CARRIER, DELIVERED, "day"),
        "PO.25": lambda: _gt_null(o, APPROVED, delivery, lambda d: d == focus.delivery_days[0]),
        "PO.26": lambda: _gt_null(o, APPROVED, delivery, lambda d: d == focus.delivery_days[1]),
        "PO.27": lambda: _gt_null(o, APPROVED, delivery, lambda d: d < 0),
    }


def customers_profile(raw: Tables, focus: Focus = Focus()) -> Report:
    c = raw["customers"]
    cols = ["customer_id", "customer_unique_id", "customer_zip_code_prefix", "customer_city", "customer_state"]
    return {
        "PC.1": lambda: p.cardinality_ratio(c, "customer_unique_id", "customer_id", 3),
        "PC.2": lambda: v.null_profile(c, cols),
        "PC.3": lambda: p.freq_distribution(c, "customer_state"),
        "PC.4": lambda: p.fanout_distribution(c, "customer_unique_id"),
        "PC.5": lambda: p.domain_joined(c, "customer_state"),
        "PC.6": lambda: p.value_range(c, ["customer_zip_code_prefix"]),
        "PC.7": lambda: p.fd_violations(c, "customer_unique_id", ["customer_city", "customer_state"]),
    }


def items_profile(raw: Tables, focus: Focus = Focus()) -> Report:
    i, o = raw["order_items"], raw["orders"]
    mine = F.col("seller_id") == focus.anomalous_seller
    late, anomalous = F.col(SHIP_LIMIT) >= _ts(focus.late_limit), F.col(SHIP_LIMIT) >= _ts(focus.cutoff)
    lifecycle = ["order_status", PURCHASE, APPROVED, CARRIER, DELIVERED]
    return {
        "PI.1": lambda: p.table_profile(i, ["order_id", "order_item_id", "product_id", "seller_id"]),
        "PI.2": lambda: p.cardinality_ratio(i, "order_id"),
        "PI.3": lambda: v.null_profile(i, ["product_id", "seller_id", "price", "freight_value", SHIP_LIMIT]),
        "PI.4": lambda: p.numeric_summary(i, ["price", "freight_value"]),
        "PI.5": lambda: p.fanout_distribution(i, "order_id"),
        "PI.6": lambda: p.value_range(
            i,
            [SHIP_LIMIT],
            {
                "negative_price": F.count_if(F.col("price") < 0),
                "negative_freight": F.count_if(F.col("freight_value") < 0),
                "free_shipping": F.count_if(F.col("freight_value") == 0),
            },
        ),
        "PI.7": lambda: p.join_inspect(
            i, o, "order_id", late, ["order_id", PURCHASE, SHIP_LIMIT], [F.desc(SHIP_LIMIT)]
        ),
        "PI.8": lambda: p.join_inspect(
            i,
            o,
            "order_id",
            anomalous,
            ["order_id", "order_item_id", "product_id", "seller_id", SHIP_LIMIT, *lifecycle],
        ),
        "PI.9": lambda: p.table_profile(i.filter(mine & anomalous), ["order_id"]),
        "PI.10": lambda: p.rule_counts(i, {"total_rows": mine}),
    }


def payments_profile(raw: Tables, focus: Focus = Focus()) -> Report:
    y = raw["order_payments"]
    value, parts = "payment_value", "payment_installments"
    cols = ["order_id", "payment_sequential", "payment_type", parts, value]
    return {
        "PP.1": lambda: p.cardinality_ratio(
            y, "order_id", extra={"avg_payment_value": F.round(F.avg(value), 2)}
        ),
        "PP.2": lambda: p.fanout_distribution(y, "order_id", share=False),
        "PP.3": lambda: p.freq_distribution(y, "payment_type"),
        "PP.4": lambda: p.numeric_summary(y, [parts]),
        "PP.5": lambda: p.numeric_summary(
            y, [value], rules={"negative_count": F.col(value) < 0, "zero_count": F.col(value) == 0}
        ),
        "PP.6": lambda: p.inspect_rows(y, F.col(value) <= 0),
        "PP.7": lambda: p.inspect_rows(y, F.col("order_id") == focus.order),
        "PP.8": lambda: v.null_profile(y, cols),
        "PP.9": lambda: p.sequence_gaps(y, "order_id", "payment_sequential"),
        "PP.10": lambda: p.filtered_group_count(y, F.col(parts) == 0, ["payment_type", parts]),
        "PP.11": lambda: a.not_in_null_aware(raw["orders"], y, "order_id"),
        "PP.12": lambda: p.sequence_gap_lists(y, "order_id", "payment_sequential").orderBy("order_id", "page").limit(20),
    }


def reviews_profile(raw: Tables, focus: Focus = Focus()) -> Report:
    r = raw["order_reviews"]
    created, answered, message = "review_creation_date", "review_answer_timestamp", "review_comment_message"
    return {
        "PR.1": lambda: p.table_profile(r, ["review_id", "order_id"]),
        "PR.2": lambda: p.freq_distribution(r, "review_score").orderBy("review_score"),
        "PR.3": lambda: r.agg(
            *[m.null_count(c).alias(f"null_{c}") for c in ("review_score", "review_comment_title", message)],
            m.percent(m.null_count(message), m.rows()).alias("pct_null_message"),
        ),
        "PR.4": lambda: p.null_share_by_group(r, "review_score", message),
        "PR.5": lambda: p.fanout_distribution(r, "order_id", share=False),
        "PR.6": lambda: v.null_profile(r, [answered, created]),
        "PR.7": lambda: p.value_range(r, [answered, created]),
        "PR.8": lambda: p.repeated_key_rows(r, "order_id")
        .select("order_id", "review_id", "review_score", created, answered, message)
        .orderBy("order_id"),
        "PR.9": lambda: p.temporal_order_violations(r, {"answered_before_created": (created, answered)}),
        "PR.10": lambda: p.value_range(r, ["review_score"]),
        "PR.11": lambda: p.numeric_summary(
            r.filter(F.col(message).isNotNull()), {"message_length": F.char_length(message)}
        ),
    }


def sellers_profile(raw: Tables, focus: Focus = Focus()) -> Report:
    s, i, o = raw["sellers"], raw["order_items"], raw["orders"]
    zip_code, city, state = "seller_zip_code_prefix", "seller_city", "seller_state"

    def of_seller(seller: str) -> DataFrame:
        return i.filter(F.col("seller_id") == seller)

    return {
        "PS.1": lambda: p.table_profile(s, ["seller_id", city, state, zip_code]),
        "PS.2": lambda: v.null_profile(s, [zip_code, city, state]),
        "PS.3": lambda: p.freq_distribution(s, state, share=False),
        "PS.4": lambda: p.value_range(s, [zip_code], {"state_length": F.max(F.char_length(state))}),
        "PS.5": lambda: p.fd_violations(s, zip_code, city),
        "PS.6": lambda: p.fd_variants(s, zip_code, city),
        "PS.7": lambda: p.fd_violations(s, city, state),
        "PS.8": lambda: p.fd_variants(s, city, state),
        "PS.9": lambda: p.domain_listing(s.select(tx.lower_trimmed(city).alias(city)), city),
        "PS.10": lambda: p.freq_distribution(s, city, share=False),
        "PS.11": lambda: p.inspect_rows(s, F.col(city) == focus.city),
        "PS.12": lambda: p.inspect_rows(s, F.col(state) == focus.states[0]),
        "PS.13": lambda: p.join_inspect(of_seller(focus.joined_seller), o, "order_id"),
        "PS.14": lambda: p.semi_lookup(o, of_seller(focus.listed_seller), "order_id"),
        "PS.15": lambda: p.inspect_rows(s, F.col(state) == focus.states[1]),
    }


def geolocation_profile(raw: Tables, focus: Focus = Focus()) -> Report:
    geo = raw["geolocation"]
    zip_code, city, state = "geolocation_zip_code_prefix", "geolocation_city", "geolocation_state"
    lat, lng = "geolocation_lat", "geolocation_lng"
    return {
        "PG.1": lambda: p.table_profile(geo, [zip_code, city, state, lat, lng]).withColumn(
            "avg_rows_per_zip", m.ratio(F.col("row_count"), F.col(f"distinct_{zip_code}"))
        ),
        "PG.2": lambda: p.bounds_check(geo, {lat: k.LATITUDE, lng: k.LONGITUDE}),
        "PG.3": lambda: p.fd_violations(geo, zip_code, city),
        "PG.4": lambda: p.fd_variants(geo, zip_code, city),
        "PG.5": lambda: p.fd_violations(geo, city, state),
        "PG.6": lambda: p.fd_variants(geo, city, state),
        "PG.7": lambda: p.normalization_effect(geo, city, tx.lower_trimmed),
        "PG.8": lambda: p.normalization_effect(geo, city, tx.folded),
        "PG.9": lambda: p.normalization_variants(geo, city, tx.folded).orderBy(F.desc("rows"), "normalized", "page"),
        "PG.10": lambda: p.normalization_reduction(geo, zip_code, city, tx.folded),
    }


def products_profile(raw: Tables, focus: Focus = Focus()) -> Report:
    d = raw["products"]
    category, weight = "product_category_name", "product_weight_g"
    sizes = ["product_length_cm", "product_height_cm", "product_width_cm"]
    return {
        "PD.1": lambda: p.table_profile(d, ["product_id"]),
        "PD.2": lambda: d.agg(
            *[m.null_count(c).alias(f"null_{c}") for c in (category, weight, *sizes, "product_photos_qty")],
            m.percent(m.null_count(category), m.rows()).alias("pct_null_category"),
        ),
        "PD.3": lambda: d.agg(F.count_distinct(category).alias("distinct_categories")),
        "PD.4": lambda: p.value_range(d, [weight], {"zero_weight_count": F.count_if(F.col(weight) == 0)}),
        "PD.5": lambda: p.value_range(d, sizes),
        "PD.6": lambda: p.top_k_values(d, category, 10),
        "PD.7": lambda: p.value_range(d, ["product_description_lenght", "product_name_lenght", "product_photos_qty"]),
        "PD.8": lambda: p.semi_lookup(
            raw["order_items"].select("product_id").distinct(), d.filter(F.col(category).isNull()), "product_id"
        ),
        "PD.9": lambda: p.group_median(
            d, category, weight, (F.col(category) == focus.median_category) & (F.col(weight) > 0)
        ).select("median"),
    }


def translation_profile(raw: Tables, focus: Focus = Focus()) -> Report:
    t, d = raw["category_translation"], raw["products"]
    category = "product_category_name"
    cols = ["string_field_0", "string_field_1"]
    return {
        "PT.1": lambda: p.table_profile(t, cols, cols),
        "PT.2": lambda: p.inspect_rows(t),
        "PT.3": lambda: a.missing_keys(d, t, category, "string_field_0", F.col(category).isNotNull()),
        "PT.4": lambda: a.unused_reference(t, d, "string_field_0", category),
    }


def integrity_audit(raw: Tables, focus: Focus = Focus()) -> Report:
    o, i, y, r = raw["orders"], raw["order_items"], raw["order_payments"], raw["order_reviews"]
    c, s, d = raw["customers"], raw["sellers"], raw["products"]
    geo, t = raw["geolocation"], raw["category_translation"]
    category, geo_zip = "product_category_name", "geolocation_zip_code_prefix"
    has_category = F.col(category).isNotNull()
    as_of = None if focus.as_of is None else F.lit(focus.as_of).cast("timestamp")

    def no_translation() -> DataFrame:
        return a.coverage_gap(d, t, category, "string_field_0", predicate=has_category)

    def register() -> DataFrame:
        issues = {
            "orphan_items_no_order": rg.Relation("order_items", "orders", "order_id"),
            "orphan_payments_no_order": rg.Relation("order_payments", "orders", "order_id"),
            "orphan_reviews_no_order": rg.Relation("order_reviews", "orders", "order_id"),
            "delivered_before_purchase": rg.Rule("orders", F.col(DELIVERED) < F.col(PURCHASE)),
            "non_positive_price": rg.Rule("order_items", F.col("price") <= 0),
            "invalid_review_score": rg.Rule("order_reviews", ~F.col("review_score").between(1, 5)),
            "duplicate_order_ids": rg.Duplicates("orders", "order_id"),
            "categories_missing_translation": rg.Relation("products", "category_translation", category, "string_field_0"),
        }
        return rg.evidence_lines(rg.integrity_register(raw, issues), {"categories_missing_translation": F.col("orphan_keys")})

    return {
        "RI.1": lambda: a.parents_without_children(o, i, "order_id"),
        "RI.2": lambda: a.childless_rows(
            o,
            i,
            "order_id",
            F.col("order_status").isin("created", "invoiced", "shipped"),
            ["order_id", "order_status", PURCHASE, APPROVED, CARRIER, DELIVERED],
        ).orderBy("order_status", "order_id"),
        "RI.3": lambda: a.orphan_count(y, o, "order_id"),
        "RI.4": lambda: a.parents_without_children(o, y, "order_id"),
        "RI.5": lambda: a.orphan_count(r, o, "order_id"),
        "RI.6": lambda: a.parents_without_children(o, r, "order_id", pct=True),
        "RI.7": lambda: a.orphan_count(o, c, "customer_id"),
        "RI.8": lambda: a.orphan_count(i, d, "product_id"),
        "RI.9": lambda: a.orphan_count(i, s, "seller_id"),
        "RI.10": lambda: a.orphan_count(i, o, "order_id"),
        "RI.11": lambda: no_translation().select("missing_keys"),
        "RI.12": lambda: a.parents_without_children(o, i, "order_id", "order_status"),
        "RI.13": lambda: a.parents_without_children(o, y, "order_id", "order_status"),
        "RI.14": lambda: a.coverage_gap(c, geo, "customer_zip_code_prefix", geo_zip).select("missing_keys"),
        "RI.15": lambda: a.coverage_gap(s, geo, "seller_zip_code_prefix", geo_zip).select("missing_keys"),
        "RI.16": lambda: a.parents_without_children(o, i, "order_id", "order_status", pct=True),
        "RI.17": lambda: a.coverage_gap(c, geo, "customer_zip_code_prefix", geo_zip, "customer_state"),
        "RI.18": lambda: a.coverage_gap(s, geo, "seller_zip_code_prefix", geo_zip, "seller_state"),
        "RI.19": lambda: p.temporal_order_violations(
            o,
            {
                "approved_before_purchase": (PURCHASE, APPROVED),
                "carrier_before_approved": (APPROVED, CARRIER),
                "customer_before_carrier": (CARRIER, DELIVERED),
                "delivered_before_purchase": (PURCHASE, DELIVERED),
            },
        ),
        "RI.20": lambda: p.rule_counts(
            i, {"non_positive_price": F.col("price") <= 0, "negative_freight": F.col("freight_value") < 0}
        ),
        "RI.21": lambda: p.rule_counts(y, {"non_positive_payment_value": F.col("payment_value") <= 0}),
        "RI.22": lambda: a.range_rule(r, "review_score", 1, 5, "invalid_review_score"),
        "RI.23": lambda: a.future_dated(o, PURCHASE, as_of),
        "RI.24": lambda: a.duplicate_keys(o, "order_id"),
        "RI.25": lambda: a.duplicate_keys(i, ["order_id", "order_item_id"]),
        "RI.26": lambda: a.duplicate_keys(d, "product_id"),
        "RI.27": lambda: a.duplicate_keys(s, "seller_id"),
        "RI.28": lambda: a.duplicate_rows(o, ["order_id", "customer_id", "order_status", PURCHASE]),
        "RI.29": register,
        # Kept apart in the catalogue: the zero payments behind the register.
        "RI.zero_rows": lambda: p.inspect_rows(y, F.col("payment_value") == 0).orderBy("order_id", "payment_sequential"),
        "RI.zero_orders": lambda: a.zero_value_audit(y, "order_id", "payment_value", "payment_type"),
        "RI.zero_status": lambda: a.zero_value_parents(
            y, o, "order_id", "payment_value", ["order_id", "order_status", "payment_type"]
        ),
    }


def clean_orders_checks(raw: Tables, clean: Tables, focus: Focus = Focus()) -> Report:
    o, i = clean["orders"], clean["order_items"]
    flags = [
        "is_delivered_missing_final_date_only",
        "is_delivered_missing_multiple_dates_anomaly",
        "is_delivered_missing_approval_anomaly",
        "is_delivered_missing_carrier_anomaly",
        "is_canceled_with_delivery_date_anomaly",
        "is_delivery_before_carrier_anomaly",
        "is_carrier_before_approval_anomaly",
    ]
    undelivered = (F.col("order_status") == "delivered") & F.col(DELIVERED).isNull()
    return {
        "CO.1": lambda: cleaning.clean_orders(raw["orders"]),
        "CO.2": lambda: v.row_parity(raw["orders"], o),
        "CO.3": lambda: v.pk_unique(o, "order_id"),
        "CO.4": lambda: v.null_profile(o, [APPROVED, CARRIER, DELIVERED]),
        "CO.5": lambda: p.domain_listing(o, "order_status"),
        "CO.6": lambda: v.domain(o, "order_status", ORDER_STATES),
        "CO.7": lambda: p.value_range(o, [PURCHASE], {"null_purchase": m.null_count(PURCHASE)}),
        "CO.8": lambda: v.flag_counts(o, flags),
        "CO.9": lambda: v.mutually_exclusive(o, flags[0], flags[1]),
        "CO.10": lambda: v.reconcile(o, flags[:2], undelivered),
        "CO.11": lambda: p.semi_lookup(
            i, o.filter(tp.in_month(PURCHASE, focus.month)), "order_id"
        ),
    }


def clean_customers_checks(raw: Tables, clean: Tables, focus: Focus = Focus()) -> Report:
    c = clean["customers"]
    cols = ["customer_id", "customer_unique_id", "customer_zip_code_prefix", "customer_city", "customer_state"]
    return {
        "CC.1": lambda: cleaning.clean_customers(raw["customers"]),
        "CC.2": lambda: v.row_parity(raw["customers"], c),
        "CC.3": lambda: v.pk_unique(c, "customer_id"),
        "CC.4": lambda: v.pk_unique(c, "customer_id", "customer_unique_id"),
        "CC.5": lambda: v.null_profile(c, cols),
        "CC.6": lambda: p.domain_listing(c, "customer_state"),
        "CC.7": lambda: v.domain(c, "customer_state", FEDERAL_STATES),
        "CC.8": lambda: v.code_format(c, "customer_zip_code_prefix"),
        "CC.9": lambda: v.standardized(c, {"customer_city": tx.lower_trimmed("customer_city")}),
        "CC.10": lambda: v.flagged_keys(c, "has_multiple_addresses_on_record", "customer_unique_id"),
        "CC.11": lambda: a.orphan_count(clean["orders"], c, "customer_id"),
    }


def clean_items_checks(raw: Tables, clean: Tables, focus: Focus = Focus()) -> Report:
    i = clean["order_items"]
    cols = ["order_id", "product_id", "seller_id", "price", "freight_value", SHIP_LIMIT]
    return {
        "CI.1": lambda: cleaning.clean_order_items(raw["order_items"], focus.cutoff),
        "CI.2": lambda: v.row_parity(raw["order_items"], i),
        "CI.3": lambda: a.duplicate_keys(i, ["order_id", "order_item_id"]),
        "CI.4": lambda: v.null_profile(i, cols),
        "CI.5": lambda: v.non_negative(i, ["price", "freight_value"], zero=["price"]),
        "CI.6": lambda: v.flag_counts(i, ["is_zero_freight", "is_shipping_date_anomaly"]),
        "CI.7": lambda: p.value_range(i, [SHIP_LIMIT], {"null_ts": m.null_count(SHIP_LIMIT)}),
        "CI.8": lambda: a.orphan_count(i, clean["orders"], "order_id"),
        "CI.9": lambda: _side_by_side(
            orphan_items_missing_product=a.orphan_count(i, raw["products"], "product_id"),
            orphan_items_missing_seller=a.orphan_count(i, raw["sellers"], "seller_id"),
        ),
        "CI.10": lambda: p.domain_listing(i, "seller_id", F.col("is_shipping_date_anomaly")),
    }


def clean_payments_checks(raw: Tables, clean: Tables, focus: Focus = Focus()) -> Report:
    y = clean["order_payments"]
    cols = ["order_id", "payment_sequential", "payment_type", "payment_installments", "payment_value"]
    odd = F.col("is_zero_payment_value") & ~F.col("is_undefined_payment_type") & (F.col("payment_type") != "voucher")
    late = "has_missing_sequential_start"
    return {
        "CP.1": lambda: cleaning.clean_payments(raw["order_payments"]),
        "CP.2": lambda: v.row_parity(raw["order_payments"], y),
        "CP.3": lambda: a.duplicate_keys(y, ["order_id", "payment_sequential"]),
        "CP.4": lambda: v.null_profile(y, cols),
        "CP.5": lambda: p.domain_listing(y, "payment_type"),
        "CP.6": lambda: v.non_negative(y, ["payment_value", "payment_installments"]),
        "CP.7": lambda: v.flag_counts(y, ["is_undefined_payment_type", "is_zero_payment_value", "is_zero_installments"]),
        "CP.8": lambda: v.implication(y, {"unexplained_zero_value_rows": odd}),
        "CP.9": lambda: a.orphan_count(y, clean["orders"], "order_id"),
        "CP.10": lambda: p.sequence_gaps(y, "order_id", "payment_sequential", "payment_type")
        .filter(F.col("distinct_payment_type") == 1)
        .orderBy("order_id")
        .limit(20),
        "CP.11": lambda: v.flagged_keys(y, late, "order_id"),
        "CP.12": lambda: v.flagged_groups_with_variety(y, late, "order_id", "payment_type"),
    }


def clean_products_checks(raw: Tables, clean: Tables, focus: Focus = Focus()) -> Report:
    d = clean["products"]
    category, weight, imputed = "product_category_name", "product_weight_g", "had_zero_weight_imputed"
    return {
        "CD.1": lambda: cleaning.clean_products(raw["products"]),
        "CD.2": lambda: v.row_parity(raw["products"], d),
        "CD.3": lambda: v.pk_unique(d, "product_id"),
        "CD.4": lambda: p.rule_counts(
            d,
            {
                "remaining_nulls": F.col(category).isNull(),
                "unknown_count": F.col(category) == "unknown",
                "flagged_count": F.col("had_null_category"),
            },
        ),
        "CD.5": lambda: p.rule_counts(d, {"remaining_zero_weight": F.col(weight) == 0, "imputed_count": F.col(imputed)}),
        "CD.6": lambda: p.inspect_rows(d, F.col(imputed), ["product_id", category, weight, imputed]),
        "CD.7": lambda: v.non_negative(d, [weight, "product_length_cm", "product_height_cm", "product_width_cm"]),
        "CD.8": lambda: p.domain_listing(d, category).limit(20),
        "CD.9": lambda: a.orphan_count(clean["order_items"], d, "product_id"),
    }


def clean_translation_checks(raw: Tables, clean: Tables, focus: Focus = Focus()) -> Report:
    t = clean["category_translation"]
    local, english = "category_name_portuguese", "category_name_english"
    category = "product_category_name"
    return {
        "CT.1": lambda: cleaning.clean_translation(raw["category_translation"]),
        "CT.2": lambda: v.row_parity(raw["category_translation"], t),
        "CT.3": lambda: v.pk_unique(t, local),
        "CT.4": lambda: v.null_profile(t, [local, english]),
        "CT.5": lambda: v.standardized(t, {c: tx.lower_trimmed(c) for c in (local, english)}),
        "CT.6": lambda: a.coverage_gap(
            clean["products"], t, category, local, predicate=F.col(category) != "unknown"
        ).select("missing_keys"),
    }


def clean_reviews_checks(raw: Tables, clean: Tables, focus: Focus = Focus()) -> Report:
    r = clean["order_reviews"]
    texts = ["review_comment_title", "review_comment_message"]
    return {
        "CR.1": lambda: cleaning.clean_reviews(raw["order_reviews"]),
        "CR.2": lambda: v.row_parity(raw["order_reviews"], r),
        "CR.3": lambda: v.pk_unique(r, "review_id"),
        "CR.4": lambda: v.null_profile(r, ["review_score", *texts]),
        "CR.5": lambda: p.value_range(r, ["review_score"]),
        "CR.6": lambda: p.temporal_order_violations(
            r, {"answered_before_created": ("review_creation_date", "review_answer_timestamp")}
        ),
        "CR.7": lambda: p.fanout_distribution(r, "order_id", share=False),
        "CR.8": lambda: v.standardized(r, {c: tx.trimmed(c) for c in texts}),
        "CR.9": lambda: a.orphan_count(r, clean["orders"], "order_id"),
    }


def clean_geolocation_checks(raw: Tables, clean: Tables, focus: Focus = Focus()) -> Report:
    geo = clean["geolocation"]
    zip_code, city = "geolocation_zip_code_prefix", "geolocation_city"
    cols = [zip_code, "geolocation_lat", "geolocation_lng", city, "geolocation_state"]
    return {
        "CG.1": lambda: cleaning.clean_geolocation(raw["geolocation"]),
        "CG.2": lambda: v.row_parity(raw["geolocation"], geo),
        "CG.3": lambda: p.bounds_check(geo, {"geolocation_lat": k.LATITUDE, "geolocation_lng": k.LONGITUDE}),
        "CG.4": lambda: v.null_profile(geo, cols),
        "CG.5": lambda: v.code_format(geo, zip_code),
        "CG.6": lambda: p.fd_violations(geo, zip_code, city).agg(m.rows().alias("remaining_ambiguous_zips")),
        "CG.7": lambda: v.flagged_keys(geo, "has_unresolved_city_ambiguity", zip_code),
        "CG.8": lambda: v.pattern_rows(geo, city, f"[{tx.ACCENTED}]", "rows_with_diacritics"),
        "CG.9": lambda: a.coverage_gap(clean["customers"], geo, "customer_zip_code_prefix", zip_code).select(
            "missing_keys"
        ),
    }


def clean_sellers_checks(raw: Tables, clean: Tables, focus: Focus = Focus()) -> Report:
    s = clean["sellers"]
    zip_code, wrong = "seller_zip_code_prefix", "has_wrong_attribute_city"
    return {
        "CS.1": lambda: cleaning.clean_sellers(raw["sellers"]),
        "CS.2": lambda: v.row_parity(raw["sellers"], s),
        "CS.3": lambda: v.pk_unique(s, "seller_id"),
        "CS.4": lambda: v.null_profile(s, [zip_code, "seller_city", "seller_state"]),
        "CS.5": lambda: v.code_format(s, zip_code),
        "CS.6": lambda: v.flag_counts(s, ["city_was_corrected"]),
        "CS.7": lambda: p.inspect_rows(s, F.col(wrong), ["seller_id", "seller_city", "seller_state"]),
        "CS.8": lambda: p.fd_variants(s, zip_code, "seller_city"),
        "CS.9": lambda: a.orphan_count(clean["order_items"], s, "seller_id"),
        "CS.10": lambda: v.flag_counts(s, ["city_was_corrected"]),
        "CS.11": lambda: v.flagged_by_group(s, wrong, "seller_city"),
    }


def date_checks(clean: Tables, serving: Tables, focus: Focus = Focus()) -> Report:
    o, d = clean["orders"], serving["dim_date"]

    def covered(ts: str) -> Callable[[], DataFrame]:
        return lambda: v.dimension_coverage(o.select(F.to_date(ts).alias("full_date")), d, "full_date")

    return {
        "SD.1": lambda: g.dim_date(o),
        "SD.2": lambda: v.calendar_complete(d).select("actual_rows", "expected_rows"),
        "SD.3": lambda: v.pk_unique(d, "date_key", "full_date"),
        "SD.4": lambda: v.null_or_duplicate_keys(d, "date_key"),
        "SD.5": lambda: v.calendar_bounds(d, o),
        "SD.6": covered(APPROVED),
        "SD.7": covered(CARRIER),
        "SD.8": covered(DELIVERED),
        "SD.9": lambda: v.calendar_complete(d).select("inconsistent_rows"),
        "SD.10": lambda: v.calendar_complete(d).select("inconsistent_weekend"),
    }


def item_flag_rows(clean: Tables) -> DataFrame:
    """Items (one row each) with the six flags of the junk dimension."""
    i = clean["order_items"]
    lines = i.select("order_id", "order_item_id", F.col("is_shipping_date_anomaly").alias("is_shipping_anomaly"))
    orders = clean["orders"].select("order_id", *g.ORDER_FLAGS)
    return lookup_join(lines, orders, "order_id", "inner")


def quality_flag_checks(clean: Tables, serving: Tables, focus: Focus = Focus()) -> Report:
    i, o, q = clean["order_items"], clean["orders"], serving["data_quality_flags"]
    return {
        "SF.1": lambda: g.data_quality_flags(i, o),
        "SF.2": lambda: q.agg(m.rows().alias("combination_count")),
        "SF.3": lambda: v.pk_unique(q, "data_quality_key"),
        "SF.4": lambda: a.duplicate_combinations(q, g.QUALITY_FLAGS),
        "SF.5": lambda: v.unmatched_combinations(item_flag_rows(clean), q, g.QUALITY_FLAGS),
        "SF.6": lambda: _side_by_side(
            total_order_items=i.agg(m.rows()), joined_row_count=item_flag_rows(clean).agg(m.rows())
        ),
    }


def product_checks(clean: Tables, serving: Tables, focus: Focus = Focus()) -> Report:
    d = serving["dim_product"]
    name, english = "category_name", "category_name_english"
    return {
        "SP.1": lambda: g.dim_product(clean["products"], clean["category_translation"]),
        "SP.2": lambda: v.row_parity(clean["products"], d, "product_id"),
        "SP.3": lambda: v.pk_unique(d, "product_key", "product_id"),
        "SP.4": lambda: v.null_profile(d, [name, english]),
        "SP.5": lambda: p.inspect_rows(d, F.col(name).isin(*focus.untranslated), ["product_id", name, english]),
        "SP.6": lambda: v.placeholder_fallback(d, name, english),
        "SP.7": lambda: v.translated_sample(d, name, english),
        "SP.8": lambda: a.orphan_count(clean["order_items"], d, "product_id"),
    }


def seller_checks(clean: Tables, serving: Tables, focus: Focus = Focus()) -> Report:
    s = serving["dim_seller"]
    tenure, tier = "seller_tenure_bucket", "seller_volume_tier"
    return {
        "SS.1": lambda: g.dim_seller(clean["sellers"], clean["order_items"], clean["orders"]),
        "SS.2": lambda: v.row_parity(clean["sellers"], s, "seller_id"),
        "SS.3": lambda: v.pk_unique(s, "seller_key", "seller_id"),
        "SS.4": lambda: v.null_profile(s, [tenure, tier]),
        "SS.5": lambda: clean["orders"].agg(F.max(PURCHASE).alias("true_max_purchase_date")),
        "SS.6": lambda: v.tier_sizes(s, tier),
        "SS.7": lambda: v.tier_sizes(s, tenure),
        "SS.8": lambda: v.tier_monotonic(
            s, g.seller_activity(clean["order_items"], clean["orders"]), "seller_id", tier, "order_count"
        ),
    }


def _first_orders(clean: Tables) -> DataFrame:
    people = g.first_and_latest(g.customer_orders(clean["customers"], clean["orders"]))
    return people.select("customer_unique_id", F.col("first_order_id").alias("order_id"))


def customer_checks(clean: Tables, serving: Tables, focus: Focus = Focus()) -> Report:
    c, person = serving["dim_customer"], "customer_unique_id"
    category = "first_purchase_category"

    def several_categories() -> DataFrame:
        """First orders with items of several categories, next to the category chosen.

        Sorted by person, so only the first 30 such people and, for each, the first 30
        items matter.
        """
        i, d = clean["order_items"], clean["products"]
        lines = i.select("order_id", "order_item_id", "product_id", "price")
        bought = lookup_join(lines, _first_orders(clean), "order_id", "inner")
        named = lookup_join(
            bought, d.select("product_id", "product_category_name"), "product_id", "inner"
        )
        named = stage(named.select(person, "price", "product_category_name"), "first_order_items")
        mixed = p.fd_violations(named, person, "product_category_name").select(person)
        few = F.broadcast(mixed.orderBy(person).limit(30))
        order = [F.desc("price"), F.col("product_category_name")]
        rank = F.row_number().over(W.partitionBy(person).orderBy(*order))
        kept = named.join(few, person, "left_semi").withColumn("_rank", rank).filter(F.col("_rank") <= 30)
        shown = kept.join(c.select(person, F.col(category).alias("resolved_category")), person)
        return (
            shown.orderBy(person, *order)
            .limit(30)
            .select(person, "price", "product_category_name", "resolved_category")
        )

    def discrepancies() -> DataFrame:
        expected = a.childless_rows(_first_orders(clean), clean["order_items"], "order_id")
        actual = c.filter(F.col(category).isNull())
        labels = ("expected_null_but_not_actual", "actual_null_but_not_expected")
        return a.symmetric_discrepancy(expected, actual, person, labels)

    return {
        "SC.1": lambda: g.dim_customer(
            clean["customers"], clean["orders"], clean["order_items"], clean["products"]
        ),
        "SC.2": lambda: v.row_parity(clean["customers"], c, person),
        "SC.3": lambda: v.pk_unique(c, "customer_key", person),
        "SC.4": lambda: v.null_profile(
            c, ["customer_key", person, "customer_state", "customer_city", "customer_zip_code_prefix", category]
        ),
        "SC.5": lambda: p.semi_lookup(
            c.select(person, "customer_state", "customer_city"),
            clean["customers"].filter("has_multiple_addresses_on_record"),
            person,
        )
        .orderBy(person)
        .limit(20),
        "SC.6": lambda: v.null_profile(c, [category]),
        "SC.7": lambda: v.repeated_keys(c, person),
        "SC.8": several_categories,
        "SC.9": discrepancies,
    }


def fact_checks(clean: Tables, serving: Tables, focus: Focus = Focus()) -> Report:
    f, o, r = serving[FACT], clean["orders"], clean["order_reviews"]
    days, on_time = F.col("delivery_estimate_error_days"), F.col("is_delivered_on_time")
    price, ratio = F.col("price"), F.col("freight_to_price_ratio")
    keys = ["customer_key", "seller_key", "product_key", "order_date_key", "data_quality_key"]
    q = serving["data_quality_flags"]

    def covers(dim: str, key: str, dim_key: str | None = None) -> Callable[[], DataFrame]:
        return lambda: v.dimension_coverage(f, serving[dim], key, dim_key)

    def on_time_nulls() -> DataFrame:
        undelivered = o.filter(F.col(DELIVERED).isNull())
        wrong = v.forbidden_in_lookup(f, ~on_time, undelivered, "order_id")
        return _side_by_side(
            null_on_time_flag=v.null_profile(f, ["is_delivered_on_time"]), false_positive_bug_check=wrong
        )

    def spot_check() -> DataFrame:
        return v.resolution_spot_check(
            f.select("order_id", "order_item_key", F.col("review_score").alias("fact_review_score")),
            r.select("order_id", "review_id", F.col("review_score").alias("raw_review_score"), "review_creation_date"),
            "order_id",
            ["order_id", "fact_review_score", "raw_review_score", "review_creation_date"],
            [F.col("order_item_key")],
            [F.desc("review_creation_date"), F.desc("review_id")],
            20,
        )

    def first_category_nulls() -> DataFrame:
        return _side_by_side(
            expected_null_count=a.parents_without_children(_first_orders(clean), clean["order_items"], "order_id"),
            actual_null_count=v.null_profile(serving["dim_customer"], ["first_purchase_category"]),
        )

    def without_product() -> DataFrame:
        """Items of first orders whose product is unknown."""
        lines = clean["order_items"].select("order_id", "order_item_id", "product_id")
        bought = lookup_join(lines, _first_orders(clean), "order_id", "inner")
        products = clean["products"].select("product_id")
        missing = lookup_join(bought, products, "product_id", "anti")
        return missing.select("customer_unique_id", "order_id", "product_id")

    return {
        "SX.1": lambda: star.build_fact(clean, serving),
        "SX.2": lambda: v.row_parity(clean["order_items"], f),
        "SX.3": lambda: v.null_equivalence(f, "delivery_estimate_error_days", "is_delivered_on_time"),
        "SX.4": lambda: v.implication(
            f, {"late_but_flagged_ontime": (days > 0) & on_time, "early_but_flagged_late": (days < 0) & ~on_time}
        ),
        "SX.5": lambda: v.implication(f, {"same_day_boundary_rows": (days == 0) & ~on_time}),
        "SX.6": lambda: v.denormalized_consistency(f, "order_id", "delivery_estimate_error_days"),
        "SX.7": lambda: v.distribution_sanity(f.filter(days.isNotNull()), "delivery_estimate_error_days"),
        "SX.8": lambda: v.pk_unique(f, "order_item_key", ["order_id", "order_item_id"]),
        "SX.9": lambda: v.null_profile(f, keys),
        "SX.10": on_time_nulls,
        "SX.11": lambda: v.implication(
            f,
            {
                "unexpected_non_null": (price == 0) & ratio.isNotNull(),
                "unexpected_null": (price != 0) & ratio.isNull(),
            },
        ),
        "SX.12": spot_check,
        "SX.13": lambda: v.rollup_equals_or(f, q, "data_quality_key", "has_fulfillment_anomaly", g.QUALITY_FLAGS),
        "SX.14": lambda: v.schema_excludes(f, "%payment%"),
        "SX.15": covers("dim_customer", "customer_key"),
        "SX.16": covers("dim_seller", "seller_key"),
        "SX.17": covers("dim_product", "product_key"),
        "SX.18": covers("dim_date", "order_date_key", "date_key"),
        "SX.19": covers("data_quality_flags", "data_quality_key"),
        "SX.20": lambda: v.repeated_keys(serving["dim_customer"], "customer_unique_id"),
        "SX.21": first_category_nulls,
        "SX.22": lambda: v.fallback_fired(serving["dim_product"], "category_name", "category_name_english"),
        "SX.23": lambda: v.grain_null_reconcile(o, f, "order_id", DELIVERED, "is_delivered_on_time"),
        "SX.24": without_product,
        "SX.25": lambda: a.outer_compare(
            clean["products"],
            clean["category_translation"],
            "product_category_name",
            "category_name_portuguese",
            F.col("product_category_name") == focus.compared_category,
            F.col("category_name_portuguese").like(focus.compared_pattern),
            row_id=["product_id"],
        ),
    }


PROFILES = [
    orders_profile,
    customers_profile,
    items_profile,
    payments_profile,
    reviews_profile,
    sellers_profile,
    geolocation_profile,
    products_profile,
    translation_profile,
    integrity_audit,
]
CLEAN_CHECKS = [
    clean_orders_checks,
    clean_customers_checks,
    clean_items_checks,
    clean_payments_checks,
    clean_products_checks,
    clean_translation_checks,
    clean_reviews_checks,
    clean_geolocation_checks,
    clean_sellers_checks,
]
SERVING_CHECKS = [
    date_checks,
    quality_flag_checks,
    product_checks,
    seller_checks,
    customer_checks,
    fact_checks,
]


def all_statements(raw: Tables, clean: Tables, serving: Tables, focus: Focus = Focus()) -> Report:
    """Every statement of the catalogue, ready to call."""
    out: Report = {}
    for part in PROFILES:
        out |= part(raw, focus)
    for part in CLEAN_CHECKS:
        out |= part(raw, clean, focus)
    for part in SERVING_CHECKS:
        out |= part(clean, serving, focus)
    return out
