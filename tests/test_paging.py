"""Pages of captured results in the order of their tokens."""

import json
import os
import random
import re

from pyspark.sql import functions as F

from billframe.config import Settings
from billframe.operators import paging as P
from billframe.plans import batch_reports as B
from billframe.plans.batch import BatchPaths, run_batch
from billframe.session import configure
from tests.golden import TEST_RATES, write_batch

SCHEMA = "source_file string, token string, next_token string, body string, status string"


def chain(name, n, status="SUCCEEDED"):
    tokens = [None] + [f"{name}-{i}" for i in range(1, n)] + [None]
    return [(name, tokens[i], tokens[i + 1], json.dumps({"Items": [f"{name}{i}a", f"{name}{i}b"] if i != 2 else []}), status) for i in range(n)]


def test_chains_in_order_and_broken_ones(spark):
    rng = random.Random(6)
    jobs = {n: chain(n, k) for n, k in (("one", 1), ("two", 2), ("five", 5), ("long", 130))}
    jobs["hole"] = [p for i, p in enumerate(chain("hole", 6)) if i != 3]
    jobs["cut"] = chain("cut", 4)[:3]
    jobs["headless"] = chain("headless", 3)[1:]
    jobs["loop"] = [p[:2] + ("loop-1",) + p[3:] if p[2] is None else p for p in chain("loop", 4)]
    jobs["self"] = [p[:2] + ("self-2",) + p[3:] if p[2] is None else p for p in chain("self", 3)]
    jobs["stray"] = chain("stray", 3) + [("stray", "x", None, "{}", "SUCCEEDED")]
    jobs["copied"] = chain("copied", 3) + chain("copied", 3)[:2]
    jobs["torn"] = chain("torn", 3) + [("torn", "torn-1", "torn-2", '{"Items":["other"]}', "SUCCEEDED")]
    jobs["failed"] = chain("failed", 2, "FAILED")
    jobs["partial"] = chain("partial", 3, "PARTIAL_SUCCESS")
    jobs["nothing"] = [("nothing", None, "", '{"Items":[]}', None)]
    rows = [p for pages in jobs.values() for p in pages]
    rng.shuffle(rows)
    pages = spark.createDataFrame(rows, SCHEMA).repartition(4).cache()
    got = {r["source_file"]: r for r in P.joined_bodies(pages, "Items").collect()}
    assert set(got) == set(jobs)
    assert {k: r["chain_error"] for k, r in got.items() if r["chain_error"]} == {
        "hole": "gap", "cut": "gap", "headless": "no first page", "loop": "loop", "self": "loop", "stray": "stray page",
        "torn": "two pages for a token", "failed": "FAILED"}
    assert all(got[k]["body"] is None for k in ("hole", "cut", "loop", "failed"))
    for k in ("two", "five", "long", "copied", "partial"):
        n = len({p[1] for p in jobs[k]})
        body = json.loads(got[k]["body"])
        assert body["Items"] == [f"{k}{i}{c}" for i in range(n) if i != 2 for c in "ab"]
        assert body["JobStatus"] == jobs[k][0][4]
    assert got["one"]["body"] == jobs["one"][0][3]


def test_paged_results_in_a_batch(spark, tmp_path):
    written = write_batch(str(tmp_path))
    for stem, missing in (("north", False), ("harbour", True)):
        path = os.path.join(written["ocr"], f"{stem}.json")
        whole = json.load(open(path, encoding="utf-8"))
        doc = whole["ExpenseDocuments"][0]
        pages = [{**doc, "SummaryFields": [f], "LineItemGroups": doc["LineItemGroups"] if i == 0 else []} for i, f in enumerate(doc["SummaryFields"])]
        os.remove(path)
        for i, page in enumerate(pages):
            if missing and i == 2:
                continue
            body = {"JobStatus": "SUCCEEDED", "ExpenseDocuments": [page]}
            body |= {"RequestToken": f"t{i}"} if i else {}
            body |= {"NextToken": f"t{i + 1}"} if i + 1 < len(pages) else {}
            with open(os.path.join(written["ocr"], f"{stem}.page{7 - i}.json"), "w", encoding="utf-8") as f:
                json.dump(body, f, ensure_ascii=False)
    paths = BatchPaths(raw=written["raw"], ocr=written["ocr"], model=written["model"], out=str(tmp_path / "out"))
    out = {r["filename"]: r for r in run_batch(spark, paths, "paged", Settings(fx_rates=dict(TEST_RATES)))["outcomes"].collect()}
    assert out["north.pdf"]["outcome"] == "LOADED"
    assert (out["harbour.pdf"]["outcome"], out["harbour.pdf"]["error_message"]) == ("QUARANTINED", "EXTRACTION_FAILED")
    assert len(out) == 7


def test_bodies_cross_one_shuffle_and_copies_count_once(spark):
    page = lambda name, token, more, items, status="SUCCEEDED": (name, token, more, status, items and f'{{"Items": {items}}}')
    rows = [
        page("a", "t1", "", "[3]"), page("a", "", "t1", "[1, 2]"), page("a", "t1", "", "[3]"),
        page("b", None, "t1", "[1]"), page("b", "t1", None, "[2]"), page("b", "t1", None, "[9]"),
        page("c", None, None, "[7]", None), page("d", None, None, None), page("e", None, "x", "[1]"),
    ]
    pages = spark.createDataFrame(rows, "source_file string, token string, next_token string, status string, body string")
    found = P.joined_bodies(pages, "Items")
    got = {r["source_file"]: (r["body"], r["chain_error"]) for r in found.collect()}
    assert got == {
        "a": ('{"JobStatus":"SUCCEEDED","Items":[1,2,3]}', None), "b": (None, "two pages for a token"),
        "c": ('{"Items": [7]}', None), "d": (None, None), "e": (None, "gap")}
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("get_json_object(") == plan.count("collect_set(") == 1


def _odd_jobs(rng, n):
    """Jobs of one to nine pages, some with lost, doubled, torn, redirected, stray or unfinished pages."""
    rows = []
    for j in range(n):
        job = chain(f"j{j}", rng.randint(1, 9), rng.choice(["SUCCEEDED", "SUCCEEDED", "PARTIAL_SUCCESS", "FAILED", None]))
        for _ in range(rng.choice([0, 0, 1, 2])):
            i = rng.randrange(len(job))
            name, token, more, body, status = job[i]
            what = rng.randrange(6)
            if what == 0 and len(job) > 1:
                job.pop(i)
            elif what == 1:
                job.append(job[i])
            elif what == 2:
                job.append((name, token, more, '{"Items":["other"]}', status))
            elif what == 3:
                job[i] = (name, token, rng.choice(job)[1], body, status)
            elif what == 4:
                job.append((name, rng.choice(["", "x"]), rng.choice([None, "y"]), rng.choice([None, "{}"]), status))
            else:
                job[i] = (name, "" if token is None else token, more, body, rng.choice(["FAILED", None]))
        rows += job
    rows.append((None, None, None, "{}", "SUCCEEDED"))
    rng.shuffle(rows)
    return rows


def test_chains_followed_in_the_row_equal_ranked_ones(spark, monkeypatch):
    configure(spark)
    pages = spark.createDataFrame(_odd_jobs(random.Random(3), 400), SCHEMA).cache()
    key = lambda r: tuple(x or "" for x in r)
    ranked = sorted((tuple(r) for r in P._joined_by_ranks(pages.where("source_file is not null"), "Items").collect()), key=key)
    with monkeypatch.context() as m:
        # short chains: nothing is written, no join
        m.setattr(P, "materialize", None)
        short = sorted((tuple(r) for r in P.joined_bodies(pages, "Items").collect()), key=key)
    assert short == ranked
    assert {"gap", "loop", "stray page", "two pages for a token", "no first page", "FAILED", None} <= {r[2] for r in short}
    # both kinds in one run, many tasks
    monkeypatch.setattr(P, "ROW_CHAIN_PAGES", 4)
    monkeypatch.setattr(P, "TASK_PAGES", 100)
    assert sorted((tuple(r) for r in P.joined_bodies(pages, "Items").collect()), key=key) == ranked
    monkeypatch.setattr(P, "ROW_CHAIN_PAGES", 1000)
    assert P.joined_bodies(pages, "Items").rdd.getNumPartitions() == pages.where("source_file is not null").count() // 100 + 1


def test_text_between_brackets(spark):
    texts = ["[]", "[ ]", "[1,2]", "[[1],[2]]", '["é"]', "é", "[é]", " [1] ", "[\n1\n]", "[", "]", "", "[1]\n", '{"a":[1]}', "[ [1] ]", "7", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = dict(tuple(r) for r in df.select("i", P._inside(F.col("t"))).collect())
    assert got == {i: t if t is None else re.sub(r"^\s*\[\s*|\s*\]\s*\Z", "", t) for i, t in enumerate(texts)}


def test_page_chains_sends_bodies_through_one_shuffle(spark, tmp_path, monkeypatch):
    spark.range(240).selectExpr("id as o_orderkey", "id * 1.5 as o_totalprice", "timestamp'1996-01-02' as o_orderdate").write.parquet(f"{tmp_path}/orders.parquet")
    spark.range(700).selectExpr("id % 230 as l_orderkey", "id % 9 as l_partkey", "cast(id % 7 as int) as l_linenumber", "3.0 as l_quantity", "9.25 as l_extendedprice").write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.range(9).selectExpr("id as p_partkey", "concat('part ', id) as p_name").write.parquet(f"{tmp_path}/part.parquet")
    written = {}
    kept = B.materialize

    def seen(df, name, key=(), **more):
        written[name] = df() if callable(df) else df
        return kept(df, name, key, **more)

    for module in (B, P):
        monkeypatch.setattr(module, "materialize", seen)
    got = {r.o_orderkey: (r.chain_error, r.page_count, r.n_fields) for r in B.page_chains(spark, str(tmp_path)).collect()}
    for k in range(240):
        n = 1 + k % 5
        error = ("gap" if n >= 2 else None) if k % 7 == 0 else ("loop" if n >= 3 else None) if k % 11 == 0 else "gap" if k % 13 == 0 and n >= 2 else None
        assert got[k] == ((error, 1, 0) if error else (None, n, 3 * n)), k
    assert list(written) == ["page_chains_parsed"] and "LineItemGroups" not in written["page_chains_parsed"].schema.simpleString()
    plan = written["page_chains_parsed"]._jdf.queryExecution().executedPlan().toString()
    # one exchange of pages by document, none by token
    assert plan.count("hashpartitioning(source_file") == 1 and "token" not in "".join(x for x in plan.split("\n") if "hashpartitioning" in x.split("[")[0])
