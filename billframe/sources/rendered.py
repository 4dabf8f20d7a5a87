"""Invoices rendered from the driver's order tables (inverse-oracle inputs).

Each order becomes one mapped payload whose 13 canonical strings are printed
in a deterministic "dirty" style chosen from the order key ``k``; the clean
truth stays computable straight from the source columns. Styles:

* total_amount  k % 13 : plain | 'Rs. ' commas | '£' | 'INR ' | kerned digits |
                         '(x)' | '-' commas | 'null' | 'N/A' | '' |
                         'six thousand' | '₹' commas + ' ' | ' x GBP'
* product_amount (k div 13) % 5 on p = c*85 div 100 cents:
                         plain | '£' commas | '' | 'null' | '$ ' plain
* vat_tax_amount       : '0.00' when k % 17 = 0, else plain(c - p)
* coupon               : '52.50' when k % 19 = 0, else ''
* vat_tax_percentage k % 7 : '9%+9%' '18%' '0%' 'N/A' '' '0%+0%' '5%'
* date           k % 11 : d-M-yyyy(dd-MM) | dd/MM/yyyy | yyyy-MM-dd |
                         dd MMM yyyy | dd MMMM yyyy | MMM dd, yyyy |
                         MMMM d, yyyy | dd-MMM-yyyy | dd.MM.yyyy |
                         MM/dd/yyyy | 'last Tuesday'
* company        vendor v = 0 when (k div 2) % 3 = 0 (a hot vendor holding a
                 third of all rows) else (k div 2) % 200; printed
                 'Acme Trading 017 Ltd' (even k) / 'ACME  tráding-017 ltd.'
                 (odd k); 'null' when k % 53 = 7
* buyer          c_name; 'N/A' when k % 59 = 3
* reference      'INV/' || (k div 2) (even) / 'inv  - ' || (k div 2) (odd);
                 blank when k % 61 = 5 (mapping failure)
* currency       by c_nationkey % 6: GBP INR USD EUR ' inr ' JPY(no rate)
* flags          multiple_total_candidates when k % 9 = 0
* confidences    total_amount 30 + (k*37) % 70, company_name 50 + (k*13) % 50
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from billframe.sources.tables import dealt, table

MONTHS = "January February March April May June July August September October November December".split()


def _plain(cents: Column) -> Column:
    """'1234.56' from integer cents (non-negative)."""
    return F.format_string("%d.%02d", (cents / 100).cast("long"), (cents % 100).cast("int"))


def _commas(cents: Column) -> Column:
    """'1,234.56' from integer cents (non-negative)."""
    return F.format_number(cents.cast("decimal(20,0)") / F.lit(100), 2)


def _total_text(k: Column, c: Column) -> Column:
    p = _plain(c)
    s = k % 13
    kerned = F.concat(F.substring(p, 1, 1), F.lit(" "), F.substring(p, 2, 1), F.lit(" "), F.substring(p, 3, 100))
    return (
        F.when(s == 0, p)
        .when(s == 1, F.concat(F.lit("Rs. "), _commas(c)))
        .when(s == 2, F.concat(F.lit("£"), p))
        .when(s == 3, F.concat(F.lit("INR "), p))
        .when(s == 4, kerned)
        .when(s == 5, F.concat(F.lit("("), p, F.lit(")")))
        .when(s == 6, F.concat(F.lit("-"), _commas(c)))
        .when(s == 7, F.lit("null"))
        .when(s == 8, F.lit("N/A"))
        .when(s == 9, F.lit(""))
        .when(s == 10, F.lit("six thousand"))
        .when(s == 11, F.concat(F.lit("₹"), _commas(c), F.lit(" ")))
        .otherwise(F.concat(F.lit(" "), p, F.lit(" GBP")))
    )


def _product_text(k: Column, p: Column) -> Column:
    s = (k / 13).cast("long") % 5
    return (
        F.when(s == 0, _plain(p))
        .when(s == 1, F.concat(F.lit("£"), _commas(p)))
        .when(s == 2, F.lit(""))
        .when(s == 3, F.lit("null"))
        .otherwise(F.concat(F.lit("$ "), _plain(p)))
    )


def _date_text(k: Column, d: Column) -> Column:
    s = k % 11
    return (
        F.when(s == 0, F.date_format(d, "dd-MM-yyyy"))
        .when(s == 1, F.date_format(d, "dd/MM/yyyy"))
        .when(s == 2, F.date_format(d, "yyyy-MM-dd"))
        .when(s == 3, F.date_format(d, "dd MMM yyyy"))
        .when(s == 4, F.date_format(d, "dd MMMM yyyy"))
        .when(s == 5, F.date_format(d, "MMM dd, yyyy"))
        .when(s == 6, F.date_format(d, "MMMM d, yyyy"))
        .when(s == 7, F.date_format(d, "dd-MMM-yyyy"))
        .when(s == 8, F.date_format(d, "dd.MM.yyyy"))
        .when(s == 9, F.date_format(d, "MM/dd/yyyy"))
        .otherwise(F.lit("last Tuesday"))
    )


def _company_text(k: Column) -> Column:
    half = (k / 2).cast("long")
    v = F.when(half % 3 == 0, F.lit(0)).otherwise(half % 200)
    num = F.lpad(v.cast("string"), 3, "0")
    even = F.concat(F.lit("Acme Trading "), num, F.lit(" Ltd"))
    odd = F.concat(F.lit("ACME  tráding-"), num, F.lit(" ltd."))
    return F.when(k % 53 == 7, F.lit("null")).when(k % 2 == 0, even).otherwise(odd)


def _reference_text(k: Column) -> Column:
    half = (k / 2).cast("long").cast("string")
    return (
        F.when(k % 61 == 5, F.lit(""))
        .when(k % 2 == 0, F.concat(F.lit("INV/"), half))
        .otherwise(F.concat(F.lit("inv  - "), half))
    )


def _currency_text(nation: Column) -> Column:
    s = nation % 6
    return (
        F.when(s == 0, F.lit("GBP"))
        .when(s == 1, F.lit("INR"))
        .when(s == 2, F.lit("USD"))
        .when(s == 3, F.lit("EUR"))
        .when(s == 4, F.lit(" inr "))
        .otherwise(F.lit("JPY"))
    )


def _rate_text(k: Column) -> Column:
    s = k % 7
    return (
        F.when(s == 0, F.lit("9%+9%")).when(s == 1, F.lit("18%")).when(s == 2, F.lit("0%"))
        .when(s == 3, F.lit("N/A")).when(s == 4, F.lit("")).when(s == 5, F.lit("0%+0%")).otherwise(F.lit("5%"))
    )


def rendered_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders ⋈ customer -> raw invoice payloads (one per order).

    Columns: source_file, load_order (= o_orderkey), fields struct<13 strings>,
    extraction_confidence map, multiple_total_candidates, unmapped_metadata.
    """
    o = dealt(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate", "o_orderstatus"), "o_orderkey")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey")
    j = o.join(c, o.o_custkey == c.c_custkey, "inner")
    k = F.col("o_orderkey")
    cents = F.round(F.col("o_totalprice") * 100).cast("long")
    prod = (cents * 85 / 100).cast("long")
    vat = cents - prod
    d = F.col("o_orderdate").cast("date")
    fields = F.struct(
        _date_text(k, d).alias("date"),
        _company_text(k).alias("company_name"),
        F.when(k % 59 == 3, F.lit("N/A")).otherwise(F.col("c_name")).alias("buyer_name"),
        _reference_text(k).alias("invoice_reference_number"),
        F.when(k % 23 == 0, F.lit("None")).otherwise(F.concat(F.lit("Order status "), F.col("o_orderstatus"))).alias("product_name"),
        _product_text(k, prod).alias("product_amount"),
        _total_text(k, cents).alias("total_amount"),
        F.when(k % 4 == 0, F.lit("null")).otherwise(F.lit("GST")).alias("vat_tax_label"),
        _rate_text(k).alias("vat_tax_percentage"),
        F.when(k % 17 == 0, F.lit("0.00")).otherwise(_plain(vat)).alias("vat_tax_amount"),
        F.when(k % 19 == 0, F.lit("52.50")).otherwise(F.lit("")).alias("coupon_discount_amount"),
        F.element_at(F.array(*[F.lit(x) for x in ("Card", "UPI", "null", "Cash", "")]), (k % 5 + 1).cast("int")).alias("mode_of_payment"),
        _currency_text(F.col("c_nationkey")).alias("currency"),
    )
    conf = F.create_map(
        F.lit("total_amount"), (F.lit(30) + (k * 37) % 70).cast("double"),
        F.lit("company_name"), (F.lit(50) + (k * 13) % 50).cast("double"),
    )
    return j.select(
        F.format_string("invoice_%d.pdf", k).alias("source_file"),
        k.alias("load_order"),
        fields.alias("fields"),
        conf.alias("extraction_confidence"),
        (k % 9 == 0).alias("multiple_total_candidates"),
        F.create_map().cast("map<string,string>").alias("unmapped_metadata"),
    )


def with_mapping_gate(mapped: DataFrame) -> DataFrame:
    """C2 on rendered payloads: a blank required field is a mapping failure."""
    from billframe.operators.mapping import required_blank

    return mapped.withColumn(
        "hard_rule", F.when(required_blank(F.col("fields")), F.lit("EXTRACTION_FAILED"))
    ).withColumn(
        "error_type", F.when(F.col("hard_rule").isNotNull(), F.lit("BedrockMappingError"))
    ).withColumn(
        "failed_at_stage", F.when(F.col("hard_rule").isNotNull(), F.lit("mapping"))
    )
