"""Typed invoice records from mapped payloads: D1-D11, E1-E5, F1-F15.

Input: one row per document with
  ``fields`` struct of the 13 canonical strings, ``source_file``,
  optional ``extraction_confidence`` map<string,double>,
  optional ``multiple_total_candidates`` boolean, ``unmapped_metadata`` map,
  and optionally ``hard_rule``/``error_type``/``failed_at_stage`` set by an
  earlier stage (extraction, mapping or gates).

Output: the record columns plus ``hard_rule`` (first failing rule in record
order, NULL when the record is valid), ``error_type``, ``failed_at_stage``,
``error_detail``, ``dq_flags`` (ordered), ``low_confidence_fields`` and
``status``. One projection plus one broadcast join; no shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from billframe.config import (
    DEFAULT_SETTINGS,
    LOADED,
    LOADED_WITH_WARNINGS,
    MANDATORY_TEXT_FIELDS,
    MONEY_FIELDS,
    OPTIONAL_TEXT_FIELDS,
    QUARANTINED,
    TARGET_CURRENCY,
    Settings,
)
from billframe.functions import (
    date_is_ambiguous,
    mandatory_text,
    mandatory_text_error,
    normalize_currency,
    optional_text,
    parse_date,
    parse_money,
    rate_is_nonzero,
)
from billframe.functions.money import MONEY_TYPE
from billframe.operators.fx import attach_rates, convert, fx_table, is_reversible

ERROR_DETAIL_TYPE = "array<struct<loc:string,msg:string,type:string,input:string>>"


def _field(name: str) -> Column:
    return F.col("fields").getField(name)


def _ensure(df: DataFrame, name: str, default: Column) -> DataFrame:
    return df if name in df.columns else df.withColumn(name, default)


def build_records(mapped: DataFrame, rates: DataFrame | None = None, settings: Settings = DEFAULT_SETTINGS) -> DataFrame:
    spark = mapped.sparkSession
    rates = rates if rates is not None else fx_table(spark, settings)
    df = mapped
    df = _ensure(df, "extraction_confidence", F.create_map().cast("map<string,double>"))
    df = _ensure(df, "multiple_total_candidates", F.lit(False))
    df = _ensure(df, "unmapped_metadata", F.create_map().cast("map<string,string>"))
    df = _ensure(df, "hard_rule", F.lit(None).cast("string"))
    df = _ensure(df, "error_type", F.lit(None).cast("string"))
    df = _ensure(df, "failed_at_stage", F.lit(None).cast("string"))
    df = _ensure(df, "error_detail", F.lit(None).cast(ERROR_DETAIL_TYPE))

    # D5 + E1: currency code and its rate.
    df = df.withColumn("_ccy", normalize_currency(_field("currency")))
    df = attach_rates(df, "_ccy", rates)

    # Stage 1 — D1-D4: parse every raw field exactly once.
    parsed = {
        "_date": parse_date(_field("date")),
        **{f"_m_{m}": parse_money(_field(m)) for m in MONEY_FIELDS},
        **{f"_e_{m}": mandatory_text_error(_field(m)) for m in MANDATORY_TEXT_FIELDS},
        **{f"_v_{m}": mandatory_text(_field(m)) for m in MANDATORY_TEXT_FIELDS},
        **{f"_o_{m}": optional_text(_field(m)) for m in OPTIONAL_TEXT_FIELDS},
        "_raw_date": _field("date"),
    }
    df = df.select(*[c for c in df.columns], *[v.alias(k) for k, v in parsed.items()])

    # Stage 2 — rule booleans (cheap attribute references from here on).
    money_err = {m: F.col(f"_m_{m}").getField("error") for m in MONEY_FIELDS}
    money_val = {m: F.col(f"_m_{m}").getField("value") for m in MONEY_FIELDS}
    mand_err = {m: F.col(f"_e_{m}") for m in MANDATORY_TEXT_FIELDS}
    any_money_err = F.lit(False)
    any_negative = F.lit(False)
    for m in MONEY_FIELDS:
        any_money_err = any_money_err | money_err[m]
        any_negative = any_negative | F.coalesce(money_val[m] < 0, F.lit(False))
    any_mand_err = F.lit(False)
    for m in MANDATORY_TEXT_FIELDS:
        any_mand_err = any_mand_err | mand_err[m]
    df = df.select(
        "*",
        F.col("_date").isNull().alias("_date_err"),
        any_mand_err.alias("_mand_err"),
        any_money_err.alias("_money_err"),
        any_negative.alias("_neg"),
        F.col("fx_rate").isNull().alias("_no_rate"),
    )
    date_err, no_rate = F.col("_date_err"), F.col("_no_rate")
    field_errors = date_err | F.col("_mand_err") | F.col("_money_err")

    # 2.J precedence: upstream failure > unknown currency > first field error in
    # record order (date, company, buyer, reference, money...) > negative money.
    first_field_rule = (
        F.when(date_err, "UNPARSEABLE_DATE")
        .when(F.col("_mand_err"), "MISSING_MANDATORY_FIELD")
        .when(F.col("_money_err"), "UNPARSEABLE_DECIMAL")
    )
    validation_rule = F.when(no_rate, "EXTRACTION_FAILED").otherwise(
        F.coalesce(first_field_rule, F.when(F.col("_neg"), "NEGATIVE_MONEY_VALUE"))
    )
    hard_rule = F.coalesce(F.col("hard_rule"), validation_rule)
    error_type = F.coalesce(
        F.col("error_type"),
        F.when(no_rate, "UnhandledException").when(validation_rule.isNotNull(), "ValidationError"),
    )
    failed_at_stage = F.coalesce(
        F.col("failed_at_stage"),
        F.when(no_rate, "unknown").when(validation_rule.isNotNull(), "pydantic_validation"),
    )

    # Error details, in record order.
    def item(loc, msg, typ, inp):
        return F.struct(F.lit(loc).alias("loc"), F.lit(msg).alias("msg"), F.lit(typ).alias("type"),
                        inp.cast("string").alias("input"))

    detail_items = [F.when(date_err, item("date", "no accepted layout fits this date", "value_error", F.col("_raw_date")))]
    for m in MANDATORY_TEXT_FIELDS:
        detail_items.append(F.when(mand_err[m], item(m, "a required field holds no value",
                                                     "value_error", _field(m))))
    for m in MONEY_FIELDS:
        detail_items.append(F.when(money_err[m], item(m, "not an amount of money", "value_error", _field(m))))
    validation_detail = F.filter(F.array(*detail_items), lambda x: x.isNotNull())
    negative_detail = F.array(item("", "an amount is below zero", "value_error", F.lit(None)))
    rate_detail = F.array(item("currency", "the rate table lacks this currency", "UnknownCurrencyError", _field("currency")))
    error_detail = F.coalesce(
        F.col("error_detail"),
        F.when(no_rate, rate_detail).when(field_errors, validation_detail).when(F.col("_neg"), negative_detail),
    ).cast(ERROR_DETAIL_TYPE)
    df = df.select(
        "*",
        hard_rule.alias("_hard_rule"),
        error_type.alias("_error_type"),
        failed_at_stage.alias("_failed_at_stage"),
        error_detail.alias("_error_detail"),
    )

    # Stage 3 — FX (E2/E3) for valid records, and the output projection.
    valid = F.col("_hard_rule").isNull()
    ccy = F.col("_ccy")
    rate = F.col("fx_rate")
    converted = {m: F.when(valid, convert(money_val[m], ccy, rate)).cast(MONEY_TYPE) for m in MONEY_FIELDS}
    out_cols = [
        F.col("_date").alias("date"),
        *[F.col(f"_v_{m}").alias(m) for m in MANDATORY_TEXT_FIELDS],
        F.col("_o_product_name").alias("product_name"),
        converted["product_amount"].alias("product_amount"),
        converted["total_amount"].alias("total_amount"),
        F.col("_o_vat_tax_label").alias("vat_tax_label"),
        F.col("_o_vat_tax_percentage").alias("vat_tax_percentage"),
        converted["vat_tax_amount"].alias("vat_tax_amount"),
        converted["coupon_discount_amount"].alias("coupon_discount_amount"),
        F.col("_o_mode_of_payment").alias("mode_of_payment"),
        F.when(valid, F.lit(TARGET_CURRENCY)).otherwise(ccy).alias("currency"),
        ccy.alias("original_currency"),
        money_val["total_amount"].alias("original_total_amount"),
        money_val["product_amount"].alias("original_product_amount"),
        money_val["vat_tax_amount"].alias("original_vat_tax_amount"),
        money_val["coupon_discount_amount"].alias("original_coupon_discount_amount"),
        rate.alias("fx_rate_applied"),
        F.col("fx_as_of").alias("fx_rate_date"),
        F.col("extraction_confidence"),
        F.col("unmapped_metadata"),
        F.coalesce(F.col("multiple_total_candidates"), F.lit(False)).alias("multiple_total_candidates"),
        F.col("_raw_date").alias("raw_date"),
        F.col("_hard_rule").alias("hard_rule"),
        F.col("_error_type").alias("error_type"),
        F.col("_failed_at_stage").alias("failed_at_stage"),
        F.col("_error_detail").alias("error_detail"),
    ]
    internal = {"fields", "extraction_confidence", "unmapped_metadata", "multiple_total_candidates", "hard_rule",
                "error_type", "failed_at_stage", "error_detail", "fx_rate", "fx_as_of"}
    passthrough = [c for c in mapped.columns if c not in internal]
    records = df.select(*passthrough, *out_cols)
    return with_dq_flags(records, settings)


def with_dq_flags(records: DataFrame, settings: Settings = DEFAULT_SETTINGS) -> DataFrame:
    """Ordered soft flags (model-local first, then contextual) and status."""
    t = F.lit(settings.low_confidence_threshold)
    conf = F.col("extraction_confidence")
    low = F.map_filter(conf, lambda k, v: v.isNotNull() & (v < t))
    low_fields = F.array_sort(F.map_keys(low))
    flags = F.filter(
        F.array(
            F.when(F.col("total_amount") == 0, F.lit("ZERO_TOTAL_AMOUNT")),
            F.when(F.col("product_amount") == 0, F.lit("ZERO_PRODUCT_AMOUNT")),
            F.when((F.col("vat_tax_amount") == 0) & rate_is_nonzero("vat_tax_percentage"), F.lit("ZERO_TAX_WITH_NONZERO_RATE")),
            F.when(F.size(low_fields) > 0, F.lit("LOW_FIELD_CONFIDENCE")),
            F.when(date_is_ambiguous("raw_date"), F.lit("AMBIGUOUS_DATE_FORMAT")),
            F.when(F.col("multiple_total_candidates"), F.lit("MULTIPLE_TOTAL_CANDIDATES")),
        ),
        lambda x: x.isNotNull(),
    )
    valid = F.col("hard_rule").isNull()
    dq_flags = F.when(valid, flags).otherwise(F.array().cast("array<string>"))
    return records.withColumn("dq_flags", dq_flags).withColumn(
        "low_confidence_fields", F.when(valid, low_fields).otherwise(F.array().cast("array<string>"))
    ).withColumn(
        "status",
        F.when(~valid, F.lit(QUARANTINED)).when(F.size("dq_flags") == 0, F.lit(LOADED)).otherwise(F.lit(LOADED_WITH_WARNINGS)),
    )


def fx_audit(records: DataFrame) -> DataFrame:
    """E5: add ``fx_reversible`` for valid records."""
    originals = [F.col(f"original_{m}") for m in MONEY_FIELDS]
    stored = [F.col(m) for m in MONEY_FIELDS]
    return records.withColumn(
        "fx_reversible",
        F.when(F.col("hard_rule").isNull(), is_reversible(originals, stored, F.col("fx_rate_applied"))),
    )
