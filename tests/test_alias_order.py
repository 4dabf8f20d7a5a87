"""Aliases learned within a batch equal a replay document by document; hot vendors spread."""

import random

from billframe.config import canonical_names, defaults, required_names
from billframe.operators import mapping as M
from billframe.operators.skew import join_unique

NAMES = list(canonical_names())


def invoices(rng, n):
    """(source_file, load_order, vendor, printed labels, model payload or None) of a batch."""
    out = []
    for i in range(n):
        v = 0 if rng.random() < 0.3 else rng.randrange(200)
        vendor = f"Vendor {v}"
        kinds = [c for c in NAMES if c not in ("company_name",) and rng.random() < (0.9 if v % 3 else 0.6)]
        printed = {f"L{v % 2}-{c}": f"{c} {i}" for c in kinds}
        printed["Seller"] = vendor
        fields = {c: printed.get(f"L{v % 2}-{c}", defaults().get(c, "x")) for c in NAMES} | {"company_name": vendor if rng.random() < 0.95 else "Other Name"}
        cited = {c: f"L{v % 2}-{c}" for c in kinds} | {"company_name": "Seller"}
        payload = None if rng.random() < 0.1 else (fields, {c: x for c, x in cited.items() if rng.random() < 0.95})
        out.append((f"f{i}.pdf", i * 3, vendor, printed, payload))
    return out


def fold(name):
    return "".join(c for c in name.upper() if c.isalnum())


def replay(batch, known=None):
    """The routing document by document."""
    cache, out = dict(known or {}), {}
    for name, order, vendor, printed, payload in batch:
        entry = cache.get(fold(vendor))
        if entry and entry["coverage"] >= 0.6:
            vals = {c: printed[x] for c, x in entry["labels"].items() if printed.get(x)}
            fields = {c: vals.get(c) or entry["constants"].get(c) or defaults().get(c, "") for c in NAMES}
            if all(fields[c].strip() for c in required_names()):
                out[name] = ("vendor_alias_cache", fields)
                continue
        if payload is None:
            out[name] = ("bedrock", None)
            continue
        fields, labels = payload
        out[name] = ("bedrock", fields)
        constants = {} if "currency" in labels else {"currency": fields["currency"]}
        coverage = len(set(labels) | set(constants)) / len(NAMES)
        key = fold(fields["company_name"])
        if labels and coverage >= cache.get(key, {"coverage": 0})["coverage"]:
            cache[key] = {"labels": labels, "constants": constants, "coverage": coverage}
    return out


def tables(spark, batch):
    summary = spark.createDataFrame(
        [(n, (0, 0, i), "VENDOR_NAME" if x == "Seller" else "OTHER", x, v) for n, _, _, p, _ in batch for i, (x, v) in enumerate(p.items())],
        "source_file string, pos struct<branch:int,doc:int,item:int>, type string, label string, value string")
    model = spark.createDataFrame(
        [(n, p is not None, 1, tuple(p[0][c] for c in NAMES) if p else None, p[1] if p else None, {}, False, "", "m", 1, 1, "bedrock") for n, _, _, _, p in batch],
        "source_file string, mapping_ok boolean, attempts int, fields struct<" + ",".join(f"{c}:string" for c in NAMES) + ">, source_labels map<string,string>, "
        "unmapped_metadata map<string,string>, multiple_total_candidates boolean, notes string, model_id string, input_tokens int, output_tokens int, source string")
    orders = spark.createDataFrame([(n, o) for n, o, *_ in batch], "source_file string, load_order long")
    return summary, model, orders


def routed(rows):
    return {r["source_file"]: (r["source"], r["fields"].asDict() if r["fields"] else None) for r in rows}


def test_in_batch_aliases_equal_a_replay(spark, monkeypatch):
    monkeypatch.setattr(M, "ORDER_BLOCK_BITS", 6)  # several blocks of a vendor
    rng = random.Random(12)
    batch = invoices(rng, 600)
    got = routed(M.map_in_order(*tables(spark, batch)).collect())
    expected = replay(batch)
    assert got == expected
    sources = [s for s, _ in expected.values()]
    assert 50 < sources.count("vendor_alias_cache") < 500
    # entries known before
    known_rows = M.learn_entries(tables(spark, batch)[1].where("mapping_ok").join(tables(spark, batch)[2], "source_file"))
    known = {r["vendor_key"]: r.asDict() for r in known_rows.collect()}
    later = [(f"g{n}", o, *rest) for n, o, *rest in invoices(rng, 80)]
    assert routed(M.map_in_order(*tables(spark, later), known_rows).collect()) == replay(later, known)


def test_hot_keys_stay_where_they_are(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        rows = spark.range(0, 60_000, 1, 12).selectExpr("id", "case when id % 3 = 0 then 'hot' else concat('k', id % 4000) end as key").cache()
        unique = spark.createDataFrame([("hot", 1)] + [(f"k{i}", 2) for i in range(0, 4000, 2)], "key string, v int")
        got = join_unique(rows, unique, "key")
        assert got.groupBy("v").count().collect() and got.where("v = 1").count() == 20_000
        per_task = [r["n"] for r in got.where("v = 1").selectExpr("spark_partition_id() as p").groupBy("p").count().withColumnRenamed("count", "n").collect()]
        assert len(per_task) == 12 and max(per_task) < 2 * min(per_task)
        assert got.where("v = 2").count() == rows.where("key <> 'hot'").join(unique, "key").count()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def alike(n):
    """A batch whose vendors print the same labels every time; every ninth invoice leaves a required one blank."""
    out = []
    for i in range(n):
        vendor, kinds = f"Vendor {i % 4}", [c for c in NAMES if c != "company_name"]
        printed = {f"L-{c}": "" if i % 9 == 4 and c == "invoice_reference_number" else f"{c} {i}" for c in kinds} | {"Seller": vendor}
        fields = {c: f"{c} {i}" for c in NAMES} | {"company_name": vendor}
        out.append((f"f{i}.pdf", i, vendor, printed, (fields, {c: f" L-{c} " for c in kinds} | {"company_name": "Seller"})))
    return out


def stripped(batch):
    return [(n, o, v, p, m and (m[0], {c: x.strip() for c, x in m[1].items()})) for n, o, v, p, m in batch]


def test_like_invoices_take_two_rounds_and_the_last_field_of_a_label_counts(spark, monkeypatch):
    batch = alike(120)
    summary, model, orders = tables(spark, batch)
    # each label is printed once more before, with another value; some fields have no label, one vendor's name comes again with white space
    before = summary.selectExpr("source_file", "named_struct('branch', 0, 'doc', 0, 'item', pos.item - 100) as pos", "'OTHER' as type", "concat(' ', label, ' ') as label",
                                "if(label = 'Seller', ' Vendor  9 ', 'old') as value")
    bare = summary.where("label = 'Seller'").selectExpr("source_file", "named_struct('branch', 1, 'doc', 0, 'item', 0) as pos", "'VENDOR_NAME' as type", "cast(null as string) as label", "' ' as value")
    written = []
    kept = M.materialize

    def seen(df, name, *args, **more):
        written.append(name)
        return kept(df, name, *args, **more)

    monkeypatch.setattr(M, "materialize", seen)
    result = M.map_in_order(summary.unionByName(before).unionByName(bare), model, orders)
    got = routed(result.collect())
    assert got == replay(stripped(batch))
    assert written.count("alias_hits") == 2
    assert sum(s == "vendor_alias_cache" for s, _ in got.values()) == sum(i % 9 != 4 for i in range(4, 120))
    # orders that come twice double their rows, no more
    again = M.map_in_order(summary, model, orders.unionByName(orders.where("load_order = 50")))
    assert again.where("source_file = 'f50.pdf'").count() == 2 and again.count() == 121


def test_places_of_entries_are_found_without_the_entries(spark, monkeypatch):
    monkeypatch.setattr(M, "ORDER_BLOCK_BITS", 2)
    rng = random.Random(8)
    writers = [(rng.choice("ab"), rng.randrange(60), rng.choice([0.7, 0.8])) for _ in range(25)] + [("a", -1, 0.75)]
    readers = [(rng.choice("abc"), i, f"f{i}") for i in range(60)]
    found = M._best_before(spark.createDataFrame(readers, "key string, at long, source_file string"), spark.createDataFrame(writers, "key string, at long, coverage double"))
    expected = {}
    for key, at, name in readers:
        earlier = [(c, a) for k, a, c in writers if k == key and a < at]
        if earlier:
            expected[name] = max(earlier)[1]
    assert {r.source_file: r.entry_at for r in found.collect()} == expected


def test_a_payload_is_parsed_and_stripped_once(spark):
    attempts = spark.createDataFrame([("a", 1, "m", "{}")], "source_file string, attempt int, model_id string, response string")
    best = M.select_attempt(attempts)
    plan = best._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json(") == 2 and plan.count("trim(") == len(NAMES)
    assert [(r.source_file, r.mapping_ok) for r in best.collect()] == [("a", False)]
