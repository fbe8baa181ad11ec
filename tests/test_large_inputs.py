"""Results and plans that hold for tables of any size."""

import json
import math
import random

import duckdb
import pytest
from pyspark.sql import functions as F

from folioscope import catalogue
from folioscope.operators import resolve, source_documents, terms

SF = "/root/testdata/sf0.001"


def optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def joined_rows(df):
    """The most rows that a join of the plan gave, which has run."""
    found, left = [0], [df._jdf.queryExecution().executedPlan()]
    while left:
        node = left.pop()
        name = node.nodeName()
        if name == "AdaptiveSparkPlan":
            left.append(node.executedPlan())
            continue
        if "QueryStage" in name:
            left.append(node.plan())
            continue
        if "Join" in name and node.metrics().contains("numOutputRows"):
            found.append(node.metrics().apply("numOutputRows").value())
        left += [node.children().apply(k) for k in range(node.children().size())]
    return max(found)


@pytest.mark.parametrize("name", ["source_blocks", "source_items"])
def test_documents_are_parsed_once(spark, name):
    assert optimized(catalogue.QUERIES[name](spark, SF)).count("parseJson") == 1


def test_linearized_odd_documents(spark):
    text = lambda x, **more: {"label": "text", "text": x} | more
    whole = {
        "texts": [text(" a   b\t"), text("Big Words", level="2"), {"label": "section_header", "text": " Head ", "level": 3}, text("foot", content_layer="furniture"), None, text("Y " + " " * 90 + "Z")],
        "groups": [{"label": "list", "children": [{"$ref": "#/texts/0"}, {}, {"$ref": "#/texts/77"}, {"$ref": "#/texts/1"}]}], "tables": [{"captions": [{"$ref": "#/texts/0"}], "rows": [["x", 1.50]]}], "key_value_items": [text("k")],
        "body": {"children": [{"$ref": f"#/{r}"} for r in ("texts/0", "texts/1", "texts/2", "texts/3", "texts/4", "texts/5", "groups/0", "tables/0", "tables/1", "key_value_items/0", "other/0", "texts/x")] + [{}]},
    }
    docs = spark.createDataFrame([(1, json.dumps(whole)), (2, "no json"), (3, None), (4, "{}"), (5, '{"body": {"children": []}}')], "doc_id int, source string")
    rows = [tuple(r) for r in source_documents.linearized(docs).orderBy("doc_id", "ord").collect()]
    assert rows == [
        (1, 0, "#/texts/0", False, None, None, "a b", None, False), (1, 1, "#/texts/1", False, None, None, "Big Words", "titlecase", False), (1, 2, "#/texts/2", True, 3, "Head", " Head ", None, False),
        (1, 3, "#/texts/3", False, None, None, "foot", None, True), (1, 4, "#/texts/4", False, None, None, "", None, False), (1, 5, "#/texts/5", False, None, None, "Y Z", "uppercase", False),
        (1, 6, "#/groups/0", False, None, None, "- a b\n- Big Words", None, False), (1, 7, "#/tables/0", False, None, None, "Table: a b\nx | 1.5", None, False),
    ]


def test_exact_titles_are_not_multiplied(spark):
    """An item takes the lead of all records of its keys, but no more than two of a key are joined with it."""
    rng = random.Random(5)
    items = [(f"i{rng.randint(0, 60)}" if n else None, rng.choice(["", "a", "b", "c", "d", "e", None])) for n in range(120)]
    records = [(f"r{rng.randint(0, 40)}" if n else None, rng.choice(["", "a", "b", "c", "d", None]), rng.choice([None, 1, 2, 3, 50 + n])) for n in range(90)]
    most = {}
    for i, key in items:
        for name, k, c in records:
            if key and key == k:
                own = most.setdefault(i, {})
                own[name] = max(own.get(name, -1), -1 if c is None else c)
    want = {(i, max(own, key=own.get)) for i, own in most.items() if list(own.values()).count(max(own.values())) == 1}
    i, r = spark.createDataFrame(items, "item string, key string"), spark.createDataFrame(records, "base_name string, key string, citations int")
    found = resolve.exact_titles(i, r)
    assert {tuple(x) for x in found.collect()} == want and len(want) > 10
    same = resolve.exact_titles(spark.range(300).select(F.col("id").alias("item"), F.lit("k").alias("key")), spark.range(300).select(F.col("id").alias("base_name"), F.lit("k").alias("key"), F.col("id").alias("citations")))
    assert {tuple(x) for x in same.collect()} == {(n, 299) for n in range(300)}
    assert joined_rows(same) <= 600


def shuffled_mb(spark, df):
    """MB that writing ``df`` shuffles."""
    store = spark.sparkContext._jsc.sc().statusStore()
    total = lambda: sum(store.executorList(False).apply(k).totalShuffleWrite() for k in range(store.executorList(False).size()))
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    before = total()
    df.write.format("noop").mode("overwrite").save()
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    return (total() - before) / 1e6


def test_long_titles_are_not_sent_with_each_term(spark):
    rng = random.Random(3)
    long_ = " ".join("".join(rng.choices("bcdfgh", k=8)) for _ in range(3000))  # 27 KB, and nearly 6,000 terms
    papers = spark.createDataFrame([(1, long_, 5), (2, long_, 7), (3, long_[:-9], 1)], "paper_id int, title string, citation_count int")
    assert shuffled_mb(spark, terms.candidate_terms(papers)) < 3 and shuffled_mb(spark, terms.candidate_scores(papers)) < 1.5
    found = terms.candidate_terms(papers)
    assert found.count() == 5997 and found.filter("doc_freq = 3").count() == 5995
    assert {r[0] for r in found.select("example_titles").distinct().collect()} == {f"{long_} | {long_} | {long_[:-9]}", f"{long_} | {long_}"}


def test_candidates_against_plain_python(spark):
    rng = random.Random(4)
    rows = [(rng.choice([None, *range(30)]), " ".join(rng.choices(["red", "Big", "the", "1999", "12", "global", "national", "éa", "x"], k=rng.randint(0, 9))) if n % 9 else None, rng.choice([1, 2])) for n in range(200)]
    weigh, stop, region = lambda c: math.log1p(c), {"the"}, {"global", "national"}
    want = {}
    for key, title, c in set(rows):
        t = [w for w in (title or "").lower().replace("é", "e").split() if w not in stop]
        runs = [t[k : k + n] for n in (2, 3) for k in range(len(t) - n + 1)]
        runs = [" ".join(r) for r in runs if "1999" not in r and r[0] != "12" and r[-1] != "12" and not set(r) <= region]
        for term in set(runs):
            want.setdefault(term, []).append(((key is not None, key or 0), title, c, runs.count(term) * rows.count((key, title, c))))
    want = {t: (len(x), sum(y[3] for y in x), round(sum(weigh(y[2]) for y in x), 4), " | ".join(y[1] for y in sorted(x)[:3])) for t, x in want.items() if len(x) > 1}
    papers = spark.createDataFrame(rows, "paper_id int, title string, citation_count int")
    found = {r["term"]: (r["doc_freq"], r["total_freq"], r["citation_weight"], r["example_titles"]) for r in terms.candidate_terms(papers).collect()}
    close = lambda a, b: a[:2] == b[:2] and a[3] == b[3] and math.isclose(a[2], b[2], abs_tol=2e-4)
    assert found.keys() == want.keys() and len(want) > 50 and all(close(found[t], want[t]) for t in want)
    scored = {r["term"]: (r["doc_freq"], r["total_freq"]) for r in terms.candidate_scores(papers).collect()}
    assert scored == {t: x[:2] for t, x in want.items()}
    top = [r["term"] for r in terms.candidate_terms(papers, top=5).orderBy(F.desc("combined_score"), F.desc("doc_freq"), F.desc("citation_weight"), "term").collect()]
    assert len(top) == 5 and top == [r["term"] for r in terms.candidate_scores(papers).orderBy(F.desc("combined_score"), F.desc("doc_freq"), F.desc("citation_weight"), "term").limit(5).collect()]


def test_source_items_by_row(spark, tmp_path):
    """Documents aren't shuffled, and those that repeat an id, or have none, keep their own lines."""
    long_ = "word " * 201 + "\n" + "Y " + " " * 90 + "Z and more of it"
    docs = spark.createDataFrame([(1, "Big Heading Of One\na b c d."), (1, "SECOND HEADING OF IT\n\ne  f g h"), (None, "x"), (None, long_), (2, None), (3, "")], "doc_id bigint, text string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    found = catalogue.QUERIES["source_items"](spark, str(tmp_path))
    c = duckdb.connect()
    c.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    want = c.execute(catalogue.ORACLE_SQL["source_items"])
    names = [d[0] for d in want.description]
    assert sorted(map(str, (tuple(r) for r in found.select(*names).collect()))) == sorted(map(str, want.fetchall()))
    assert "Exchange" not in found._jdf.queryExecution().executedPlan().toString()
