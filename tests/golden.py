"""Seven invented invoices that between them reach every outcome of a batch.

All names, numbers, dates and amounts are made up here. At the test rates
(100 rupees and 1.25 dollars to the pound) the six valid ones are worth
120.00 + 25.00 + 40.00 + 0.00 + 310.50 + 10.00 = 505.50 pounds.
"""

from __future__ import annotations

import json
import os

# (stem, currency, date, total, product, tax, rate, coupon, multiple_totals, buyer_conf)
DOCS = [
    ("north", "GBP", "14 March 2024", "£120.00", "100.00", "20.00", "20%", "0", False, 95.0),
    ("ridge", "INR", "2023-11-30", "2,500.00", "2,000.00", "500.00", "25%", "", True, 88.0),
    ("harbour", "USD", "31/12/2024", "$50.00", "40.00", "10.00", "N/A", "0", False, 91.0),
    ("meadow", "INR", "28-02-2025", "0.00", "", "0.00", "N/A", "", False, 33.3),
    ("quarry", "GBP", "May 19, 2025", "£310.50", "310.50", "0.00", "4%+4%", "0", False, 77.0),
    ("willow", "INR", "27 August 2025", "₹1,000", "800", "₹200", "25%", "100", False, 66.0),
    ("timber", "GBP", "16.07.2025", "(75.00)", "", "", "N/A", "", False, 90.0),
]

TEST_RATES = {"INR": "100", "USD": "1.25", "GBP": "1"}


def _field(typ, label, value, conf):
    return {"Type": {"Text": typ, "Confidence": 99.0},
            "LabelDetection": {"Text": label, "Confidence": 95.0} if label else None,
            "ValueDetection": {"Text": value, "Confidence": conf}}


def write_batch(root: str) -> dict[str, str]:
    raw, ocr, model = (os.path.join(root, d) for d in ("raw", "ocr", "model"))
    for d in (raw, ocr, model):
        os.makedirs(d, exist_ok=True)
    for i, (stem, ccy, date, total, product, tax, rate, coupon, multi, bconf) in enumerate(DOCS):
        with open(os.path.join(raw, f"{stem}.pdf"), "wb") as fh:
            fh.write(b"%PDF-1.4\n% invented test document\n")
        vendor = f"{stem.title()} Supplies"
        env = {"JobStatus": "SUCCEEDED", "ExpenseDocuments": [{"ExpenseIndex": 1, "SummaryFields": [
            _field("VENDOR_NAME", "Seller", vendor, 98.0),
            _field("RECEIVER_NAME", "Customer Name", f"Buyer {i}", bconf),
            _field("INVOICE_RECEIPT_ID", "Invoice No", f"REF-{i:04d}", 96.0),
            _field("INVOICE_RECEIPT_DATE", "Invoice Date:" if i else "-\nInvoice   Date:", date, 97.0),
            _field("TOTAL", "Grand Total", total, 95.5),
        ], "LineItemGroups": [{"LineItems": [{"LineItemExpenseFields": [
            _field("ITEM", "Description", f"Service {i}", 91.0),
            _field("PRICE", "Amount", product or "0", 90.0)]}]}]}]}
        with open(os.path.join(ocr, f"{stem}.json"), "w", encoding="utf-8") as fh:
            json.dump(env, fh, ensure_ascii=False)
        payload = {
            "fields": {"date": date, "company_name": vendor, "buyer_name": f"Buyer {i}",
                       "invoice_reference_number": f"REF-{i:04d}", "product_name": f"Service {i}",
                       "product_amount": product, "total_amount": total, "vat_tax_label": "GST",
                       "vat_tax_percentage": rate, "vat_tax_amount": tax, "coupon_discount_amount": coupon,
                       "mode_of_payment": "Card", "currency": ccy},
            "source_labels": {"company_name": "Seller", "buyer_name": "Customer Name",
                              "invoice_reference_number": "Invoice No", "date": "Invoice Date:",
                              "total_amount": "Grand Total", "product_name": "Description",
                              "product_amount": "Amount"},
            "unmapped_metadata": {"address": "1 Example Road"},
            "multiple_total_candidates": multi, "model_id": "test-model",
        }
        with open(os.path.join(model, f"{stem}.mapped.json"), "w", encoding="utf-8") as fh:
            json.dump(payload, fh, ensure_ascii=False)
    return {"raw": raw, "ocr": ocr, "model": model}
