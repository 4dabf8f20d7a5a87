"""K1-K3: folded natural keys.

fold_key = compatibility-decompose, keep ASCII, upper-case, keep [A-Z0-9];
NULL -> ''.  Spark has no Unicode normaliser, so the decomposition is applied
per character with tables generated once from ``unicodedata`` (a rule, not a
hand list): per-character folding is exact because decomposition only
reorders combining marks, which the ASCII filter drops anyway.

* characters folding to one ASCII letter/digit -> one ``translate`` (JVM);
* the few characters folding to several (ligatures, circled numbers, unit
  symbols) -> a literal-map lookup that only runs, thanks to the ``when``
  guard, on strings that contain one of them;
* everything else non-ASCII is dropped by the final regex.
"""

from __future__ import annotations

import functools
import re
import sys
import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def _fold_char(ch: str) -> str:
    ascii_text = unicodedata.normalize("NFKD", ch).encode("ascii", "ignore").decode("ascii")
    return re.sub(r"[^A-Z0-9]", "", ascii_text.upper())


@functools.lru_cache(maxsize=1)
def _tables() -> tuple[str, str, dict[str, str]]:
    src, dst, multi = [], [], {}
    for cp in range(0x80, sys.maxunicode + 1):
        if 0xD800 <= cp <= 0xDFFF:
            continue
        ch = chr(cp)
        if unicodedata.category(ch) in ("Cn", "Co", "Cs"):
            continue
        out = _fold_char(ch)
        if len(out) == 1:
            src.append(ch)
            dst.append(out)
        elif len(out) > 1:
            multi[ch] = out
    return "".join(src), "".join(dst), multi


@functools.lru_cache(maxsize=1)
def _multi_class() -> str:
    """One of the characters that fold to several, as ranges; ASCII is passed over before the ranges are tried."""
    runs: list[list[int]] = []
    for cp in sorted(map(ord, _tables()[2])):
        if runs and cp == runs[-1][1] + 1:
            runs[-1][1] = cp
        else:
            runs.append([cp, cp])
    return r"(?=[^\x00-\x7F])[" + "".join(rf"\x{{{a:x}}}-\x{{{b:x}}}" for a, b in runs) + "]"


@functools.lru_cache(maxsize=1)
def _multi_json() -> str:
    import json

    return json.dumps(_tables()[2], ensure_ascii=False)


def fold_key(col) -> Column:
    src, dst, _ = _tables()
    s = F.coalesce(_c(col).cast("string"), F.lit(""))
    # One constant-folded literal keeps the expression tree small.
    multi_map = F.from_json(F.lit(_multi_json()), "map<string,string>")
    expanded = F.when(
        s.rlike(_multi_class()),
        F.array_join(F.transform(F.split(s, ""), lambda ch: F.coalesce(F.element_at(multi_map, ch), ch)), ""),
    ).otherwise(s)
    folded = F.when(s.rlike(r"[^\x00-\x7F]"), F.translate(expanded, src, dst)).otherwise(s)
    return F.upper(F.regexp_replace(folded, r"[^A-Za-z0-9]", ""))


def vendor_pk(company_col) -> Column:
    return F.concat(F.lit("VENDOR#"), fold_key(company_col))


def invoice_sk(reference_col) -> Column:
    return F.concat(F.lit("INVOICE#"), fold_key(reference_col))


def dedup_key(company_col, reference_col) -> Column:
    return F.concat_ws("|", fold_key(company_col), fold_key(reference_col))


def month_key(date_col) -> Column:
    """K3: 'yyyy-MM' reporting month of a DateType column."""
    return F.date_format(_c(date_col), "yyyy-MM")
