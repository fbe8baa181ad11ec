"""Operators on literal cases and against plain Python."""

import json
import math
import random
import unicodedata

import pytest
from pyspark.sql import functions as F

from folioscope.functions import scoring
from folioscope.functions import text as T
from folioscope.operators import bibliography, claims, containment, merge, registry, resolve, sections, seeds, terms
from folioscope.sources import files
from folioscope.streaming import registry as stream


def one(spark, f, *values):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, x string").select("i", f(F.col("x")).alias("y")).orderBy("i").collect()
    return [r["y"] for r in rows]


def test_text(spark):
    odd = ["Vitamin D, Obesity & 25-OHD!", "straße Éclair ﬁne ½ x² ﬀ", "", "İstanbul Ångström №5", "a b c"]
    plain = lambda x: unicodedata.normalize("NFKD", x).encode("ascii", "ignore").decode()
    assert one(spark, T.fold, *odd) == [plain(x) for x in odd]
    assert one(spark, T.normalized, odd[0]) == ["vitamin d obesity 25 ohd"]
    assert one(spark, lambda x: F.array_join(T.title_tokens(x), "|"), "The role of a Vitamin A in the gut") == ["role|vitamin|gut"]
    grams = one(spark, lambda x: T.ngrams(F.filter(F.split(x, " "), lambda t: t != "")), "a b c d", "a", "")
    assert grams == [["a", "b", "c", "d", "a b", "b c", "c d", "a b c", "b c d"], ["a"], []]
    assert one(spark, T.doi_slug, "https://doi.org/10.1000/ABC (x)", " DOI: 10.1/Y ", "///") == ["10.1000-abc-x", "10.1-y", "unknown-doi"]
    assert [r and (r["format"], r["doi_slug"], r["document_id"]) for r in one(spark, T.parsed_base_name, "doi-10.1-x", "D1__doi-10.1-x", "zzz")] == [("doi", "10.1-x", None), ("legacy", "10.1-x", "D1"), None]
    assert one(spark, T.doi_within, "see 10.1000/Abc.1_.", "none") == ["10.1000/abc.1", None]
    assert one(spark, lambda x: T.preview(x, 3), "a b  c d", "a b", None) == ["a b c...", "a b", ""]
    assert one(spark, T.year_within, "2004-00-00 2004", "1899", "x 1999") == ["2004", "", "1999"]
    assert one(spark, T.estimated_tokens, "   ", "ab", "a" * 10, "a" * 14) == [0, 1, 2, 4]
    assert one(spark, T.heading_signal, "RESULTS OF 2020", "Methods and Materials", "this is text.", "12") == ["uppercase", "titlecase", None, None]
    assert one(spark, T.is_definition, "BMI = body mass; BP = blood pressure", "Setting: hospital", "a: b: c", "plain = text", "") == [True, True, True, False, False]
    assert one(spark, T.title_hint, "Smith - 2004 - Gut health__from-raw-pdf-2024-01-02", "Plain") == ["Gut health", "Plain"]


def test_scores(spark):
    row = spark.range(1).select(scoring.extra_claims(F.lit(800), F.lit(12000)).alias("a"), scoring.extra_claims(F.lit(None).cast("int"), F.lit(0)).alias("b")).first()
    assert (10 + row["a"], 10 + row["b"]) == (18, 10)


PAPERS = [("p1", "Vitamin D and obesity", 2024, 3957), ("p2", "Gut microbiome in obesity", 2020, 5182), ("p3", "Sleep", None, None)]


def test_terms(spark):
    papers = spark.createDataFrame(PAPERS, "paper_id string, title string, year int, citation_count int")
    topics = terms.topic_rows(spark, {"vitamin_d": ["vitamin d", "Vitamin-D"], "obesity": ["obesity"], "gut_microbiome": ["gut microbiome"]})
    assert topics.count() == 3
    found = terms.paper_terms(papers)
    matches = terms.topic_matches(found, topics)
    assert {r["paper_id"]: (r["matched_topics"], r["matched_terms"]) for r in terms.paper_topics(papers, matches).collect()} == {"p1": ("vitamin_d; obesity", "vitamin_d:vitamin d; obesity:obesity"), "p2": ("obesity; gut_microbiome", "obesity:obesity; gut_microbiome:gut microbiome"), "p3": ("", "")}
    assert tuple(terms.summary(papers, matches).first()) == (3, 2, 1)
    assert {tuple(r) for r in terms.cooccurrence(matches).collect()} == {("obesity", "vitamin_d", 1), ("gut_microbiome", "obesity", 1)}
    assert [r["paper_id"] for r in terms.within_years(papers, 2021).collect()] == ["p1"] and terms.within_years(papers).count() == 3
    best = {r["term"]: r for r in terms.candidate_terms(papers, low=1, least=2).collect()}
    assert set(best) == {"obesity"} and math.isclose(best["obesity"]["citation_weight"], math.log1p(3957) + math.log1p(5182), abs_tol=1e-4)
    assert best["obesity"]["example_titles"] == "Vitamin D and obesity | Gut microbiome in obesity"
    drafted = terms.draft_topics(terms.candidate_terms(papers, low=1, high=2, least=1), [("one", ["sleep"]), ("two", ["obesity", "sleep"]), ("three", ["gut"])])
    got = {}
    for r in drafted.collect():
        got.setdefault(r["topic"], []).append(r["keyword"])
    assert got == {"two": ["d obesity", "microbiome obesity", "obesity", "sleep"], "three": ["gut", "gut microbiome"]}
    with pytest.raises(Exception):
        terms.topic_rows(spark, {"t": ["the"]}).collect()


def test_seeds(spark):
    m = spark.createDataFrame([("https://doi.org/10.1/A", "Diet and protein", "500"), ("10.1/b", "Diet", "5"), ("10.1/c", "Dietary fat", "900"), ("10.1/d", "Sleep", "900"), ("10.1/e", "Diet", "x")], "doi string, title string, citation_count string")
    done = spark.createDataFrame([("doi:10.1/C",)], "doi string")
    assert [tuple(r) for r in seeds.keyword_seeds(m, done, ["diet", "protein", "diet and"], 100).collect()] == [("10.1/a", "Diet and protein", 500, "diet; protein; diet and")]
    gap = seeds.gap_seeds(m.select("doi", "title"), spark.createDataFrame([("10.1/a", "old")], "doi string, title string"), m, done, [("diet", ["diet"]), ("protein", ["protein"])], 180)
    assert [tuple(r) for r in gap.collect()] == [("10.1/a", "Diet and protein", 500, "diet; protein", "unclassified", 225500)]
    queue = spark.createDataFrame([("10.1/x", 0), ("# note", 1), ("10.1/X", 2), ("10.1/c", 3), ("", 4)], "doi string, pos int")
    assert [tuple(r) for r in seeds.frontier(queue, done).collect()] == [("10.1/x", 0)]
    five = spark.createDataFrame([("s", i) for i in range(5)], "seed string, n int")
    assert sorted(r["n"] for r in seeds.batches(five, "seed", "n", 2).collect()) == [1, 2, 2]


def test_resolve(spark):
    rng = random.Random(1)
    key = lambda n: "".join(rng.choice("abc") for _ in range(n))
    long_ = [key(200) for _ in range(12)]
    items = [(f"i{k}", long_[k % 12][k : k + 24 + k]) for k in range(30)] + [("short", long_[0][:23]), ("same", long_[1])]
    records = [(f"r{k}", x, k) for k, x in enumerate(long_)] + [("rs", long_[3][5:60], 9), ("none", "", 1)]
    i, r = spark.createDataFrame(items, "item string, key string"), spark.createDataFrame(records, "base_name string, key string, citations int")
    want = {(a, b, min(len(k), len(q))) for a, k in items for b, q, _ in records if len(k) >= 24 and len(q) >= 24 and (k in q or q in k)}
    assert {(x["item"], x["base_name"], x["score"]) for x in resolve.partial_pairs(i, r).collect()} == want
    two = spark.createDataFrame([("f", "a", 541), ("f", "b", 854), ("g", "a", 5), ("g", "b", 5), ("h", "c", None)], "item string, base_name string, citations int")
    assert {tuple(x) for x in resolve.preferred(two, "item").collect()} == {("f", "b"), ("h", "c")}


def test_merge(spark):
    rows = [(1, 1, "old", None, ["b", "a"], False), (1, 2, "", "J", ["c", ""], True), (1, 3, None, None, [], None), (2, 1, None, None, None, None)]
    m = merge.metadata(spark.createDataFrame(rows, "k int, s int, title string, journal string, parents array<string>, seed boolean"), "k", "s", ["title", "journal"], ["parents"], "seed")
    assert {tuple(r[:1]) + (r["title"], r["journal"], tuple(r["parents"]), r["seed"]) for r in m.collect()} == {(1, "old", "J", ("a", "b", "c"), True), (2, None, None, (), False)}


def recursive(tree, drop):
    out = []
    for ord_, title, text, kids in tree:
        if drop(title):
            continue
        below = recursive(kids, drop)
        if below or "Table:" in text or len(text.split()) > 10:
            out += [ord_, *below]
    return out


def test_sections(spark):
    rng = random.Random(7)
    titles = ["Introduction", "Methods", "Results and Discussion", "Other", "References", "ABSTRACT", "OBJECTIVE"]
    heads, want = [], {}
    for doc in range(60):
        stack, top = [], []
        for ord_ in range(rng.randint(1, 12)):
            level, title, text = rng.randint(1, 4), rng.choice(titles), " ".join("w" * rng.randint(0, 20)) + rng.choice(["", " Table: x"])
            heads.append((doc, ord_, level, title, text))
            while stack and stack[-1][0] >= level:
                stack.pop()
            node = (ord_, title, text, [])
            (stack[-1][1][3] if stack else top).append(node)
            stack.append((level, node))
        drop = lambda t: bool({"introduction", "discussion", "references", "abstract"} & set(t.lower().split())) and not {"methods", "results"} & set(t.lower().split())
        want[doc] = sorted(recursive(top, drop))
    tree = sections.section_tree(spark.createDataFrame(heads, "doc_id int, ord int, level int, title string, text string"))
    got = {}
    for r in sections.rule_filtered(tree).collect():
        got.setdefault(r["doc_id"], []).append(r["ord"])
    assert {k: sorted(v) for k, v in got.items()} == {k: v for k, v in want.items() if v}
    levels = sections.heading_levels(spark.createDataFrame([(1, 0, "Abstract", 1), (1, 1, "AIMS", 1), (1, 2, "METHODS", None), (1, 3, "Then", 1), (1, 4, "AIMS", 1), (1, 5, "x", 3)], "doc_id int, ord int, title string, raw int"))
    assert [r["level"] for r in levels.orderBy("ord").collect()] == [1, 2, 2, 1, 1, 3]
    cells = [(1, 0, 0, 0, 1, 1, "a"), (1, 1, 0, 1, 1, 3, " b "), (1, 2, 2, 2, 3, 3, "c"), (1, 3, 0, 0, 1, 1, "z"), (1, 4, 1, 1, 2, 2, " "), (1, 5, 9, 0, 3, 1, "out")]
    assert [tuple(r) for r in sections.table_rows(spark.createDataFrame(cells, "table_id int, pos int, row int, col int, end_row int, end_col int, text string")).orderBy("row_no").collect()] == [(1, 0, "z | b | "), (1, 2, " |  | c")]
    flat = spark.createDataFrame([(1, 0, "A", "one", [0]), (1, 1, "Sub", "two", [0, 1]), (1, 2, "", "three", [2]), (1, 3, "Empty", " ", [3])], "doc_id int, ord int, title string, text string, path array<bigint>")
    assert tuple(sections.prompt_sections(flat).first()) == (1, "## A\none\n\nSub\ntwo\n\n## Untitled Section\nthree", "A, Untitled Section")


def test_claims(spark):
    good = {k: "x" for k in claims.KEYS} | {"keywords": [], "statistics": {}, "confidence": 0.5, "arm": None}
    short = {k: v for k, v in good.items() if k != "units"}
    tried = [[good, good], [good, short], [good | {"claim_text": " "}], [good | {"confidence": "0.9"}], [good | {"keywords": "a"}], [good | {"statistics": []}], [good | {"confidence": True}], {}, [1], []]
    rows = spark.createDataFrame([(i, json.dumps(x)) for i, x in enumerate(tried)] + [(98, "nope"), (99, None)], "doc_id int, output string")
    got = {r["doc_id"]: (r["valid"], r["reason"]) for r in claims.validated(rows).collect()}
    assert [i for i, (v, _) in sorted(got.items()) if v] == [0, 6, 9]
    assert got[1][1] == "claim 1 missing units" and got[2][1] == "claim 0 invalid claim_text" and got[7][1] == "not an array" and got[98][1] == "not JSON"


def test_registry_and_stream(spark, tmp_path):
    rows = [("p", "2024-01-01 00:00:00", 1, "started", "processing"), ("p", "2024-01-01 00:00:01", 2, "done", "processing"), ("p", "2024-01-01 00:00:02", 3, "done", "other"), ("q", "2024-01-01 00:00:00", 4, "done", "rag_error")]
    events = spark.createDataFrame(rows, "paper_id string, t string, seq int, event string, stage string").withColumn("ts", F.to_timestamp("t")).drop("t")
    batch = {tuple(r) for r in registry.state(events).collect()}
    assert {r[:3] for r in batch} == {("p", "completed", "pending"), ("q", "pending", "error")}
    events.write.parquet(str(tmp_path / "in"))
    q = stream.run_to_table(stream.running_state(stream.event_stream(spark, str(tmp_path / "in"), events.schema)), "registry_rows", str(tmp_path / "check"))
    q.awaitTermination(120)
    assert {tuple(r) for r in spark.table("registry_rows").collect()} == batch
    old = spark.createDataFrame([("p", "10.1/a", "old", "completed", "pending", 1), ("r", None, "r", "failed", "error", 1)], "paper_id string, doi string, prefix string, status_proc string, status_rag string, last_event int")
    new = spark.createDataFrame([("p", None, "new", None, None, 2), ("s", "10.1/s", "s", None, None, 2)], old.schema)
    assert {tuple(r) for r in registry.upserted(old, new).collect()} == {("p", "10.1/a", "new", "completed", "pending", 2), ("r", None, "r", "failed", "error", 1), ("s", "10.1/s", "s", "pending", "pending", 2)}
    n = spark.createDataFrame([(0, "metadata", 4), (1, "pdf", 2), (2, "final", 2), (3, "claims", 1)], "pos int, stage string, n int")
    assert [(r["rate_from_previous"], r["rate_from_first"]) for r in registry.funnel(n).collect()] == [(None, 100.0), (50.0, 50.0), (100.0, 50.0), (50.0, 25.0)]


def test_bibliography(spark):
    rows = [("x1", "A & B", ["Ada Lovelace"], "2024", None, "10.1/a", 1), ("x2", "C", ["Bob Lovelace"], "2024", "J_1", "10.1/b", 2), ("ABC123456", "D", [], "2004-00-00 2004", None, "10.1/c", 3), ("x4", "E", ["Q Q"], "2020", None, None, 4), ("x5", "F", ["Ann Lovelace20241"], "", None, "10.1/f", 5)]
    e = bibliography.entries(bibliography.cite_keys(bibliography.base_keys(spark.createDataFrame(rows, "paper_id string, title string, authors array<string>, year string, journal string, doi string, ord int"))))
    got = {r["citekey"]: r["entry"] for r in e.collect()}
    assert set(got) == {"Lovelace2024", "Lovelace20241", "ABC12345", "x5"}
    assert got["Lovelace2024"] == "@article{Lovelace2024,\n  title = {A \\& B},\n  author = {Ada Lovelace},\n  year = {2024},\n  doi = {10.1/a}\n}"


def test_files(spark, tmp_path):
    (tmp_path / "p.csv").write_text('paper_id,title,year\np1,"A, b",2020\np2,C,\n')
    assert [tuple(r)[:3] for r in files.papers(spark, str(tmp_path / "p.csv")).collect()] == [("p1", "A, b", 2020), ("p2", "C", None)]
    (tmp_path / "bad.csv").write_text("paper_id,title\np1,\n")
    with pytest.raises(Exception):
        files.papers(spark, str(tmp_path / "bad.csv")).collect()
    (tmp_path / "c.csv").write_text("title,doi\nA,1\n,2\nB,3\n")
    assert [r["paper_id"] for r in files.citation_rows(spark, str(tmp_path / "c.csv")).collect()] == ["citation-row-1", "citation-row-3"]
    (tmp_path / "q.txt").write_text("10.1/A\n# no\n\nhttps://doi.org/10.1/a\n10.1/b\n")
    assert sorted(tuple(r) for r in files.doi_list(spark, str(tmp_path / "q.txt")).collect()) == [("10.1/a", 0), ("10.1/b", 4)]
    assert files.doi_list(spark, str(tmp_path / "none"), "10.1/Z").first()["doi"] == "10.1/z"
    (tmp_path / "b.bib").write_text('@article{k1,\n  title = {A {B} c},\n  doi = "10.1/X"\n}\n@book{k2,\n title = bare,\n}\n')
    assert [tuple(r) for r in files.bibliography(spark, str(tmp_path / "b.bib")).collect()] == [("k1", "10.1/x", "A {B} c", "abc"), ("k2", None, "bare", "bare")]
    (tmp_path / "m").mkdir()
    (tmp_path / "m" / "a.json").write_text('{"metadata": {"doi": "10.1/A", "title": "One", "citationCount": 3}}')
    (tmp_path / "m" / "b.json").write_text('{"doi": "10.1/a", "title": "Two"}')
    (tmp_path / "m" / "c.json").write_text("{nope")
    assert [(r["doi"], r["title"]) for r in files.metadata_index(files.metadata(spark, str(tmp_path / "m"))).collect()] == [("10.1/a", "Two")]


def test_resolved(spark):
    long_ = "A long enough title about the gut microbiome of mice"
    f = lambda t: T.match_key(F.lit(t))
    meta = spark.createDataFrame([("10.1/a", "doi-10.1-a", "Alpha study", 5), ("10.1/b", "doi-10.1-b", "Beta study", 7), ("10.1/c", "doi-10.1-c", long_, 9)], "doi string, base_name string, title string, citations int").withColumn("key", T.match_key(F.col("title"))).drop("title")
    bib = spark.range(1).select(F.lit("10.1/b").alias("doi"), f("Beta: bibliography").alias("key"))
    relations = spark.range(1).select(F.lit("doi-10.1-a").alias("base_name"), f("attached").alias("key"))
    names = ["doi-10.1-z.pdf", "D9__doi-10.1-y.pdf", "Beta bibliography.pdf", "attached.pdf", "X - 2004 - Alpha study.pdf", long_[:40] + ".pdf", "unknown.pdf"]
    got = {r["file"]: (r["base_name"], r["strategy"]) for r in resolve.resolved(spark.createDataFrame([(n,) for n in names], "file string"), meta, bib, relations).collect()}
    assert [got[n] for n in names] == [("doi-10.1-z", "named"), ("doi-10.1-y", "legacy"), ("doi-10.1-b", "bib_exact"), ("doi-10.1-a", "relations_exact"), ("doi-10.1-a", "metadata_exact"), ("doi-10.1-c", "metadata_partial"), (None, None)]
    found = spark.createDataFrame([(n, *got[n]) for n in names], "file string, base_name string, strategy string")
    assert {tuple(r) for r in resolve.match_audit(found).collect()} == {("total", 7), ("already_doi", 1), ("legacy", 1), ("matched", 4), ("unmatched", 1)}


def test_fold_of_all_of_unicode(spark):
    every = [chr(c) for c in range(0x80, 0x110000) if not 0xD800 <= c < 0xE000]
    rows = [(k, "a" + "z".join(every[k : k + 100])) for k in range(0, len(every), 100)]
    got = spark.createDataFrame(rows, "c int, t string").select("t", T.fold(F.col("t")).alias("f")).collect()
    assert all(r["f"] == unicodedata.normalize("NFKD", r["t"]).encode("ascii", "ignore").decode() for r in got)


def test_cite_keys_in_turn(spark):
    rng = random.Random(1)
    lists = [[rng.choice(["A", "A1", "A11", "A111", "B", "B2", "B20", "C", "C01", "7", "77"]) for _ in range(300)], ["A"] * 12 + ["A1"] * 2, ["D"] * 5, ["E9"]]
    for bases in lists:
        used, want = set(), []
        for b in bases:
            key, n = b, 0
            while key in used:
                n += 1
                key = f"{b}{n}"
            used.add(key)
            want.append(key)
        rows = spark.createDataFrame([(b, i) for i, b in enumerate(bases)], "base string, ord int")
        assert [r["citekey"] for r in bibliography.cite_keys(rows).orderBy("ord").collect()] == want


def test_contained_keys(spark):
    rng = random.Random(2)
    texts = ["".join(rng.choice("ab1") for _ in range(rng.randint(0, 200))) for _ in range(40)]
    short = [(f"s{i}", t[a : a + rng.randint(20, 60)]) for i, t in enumerate(texts) for a in (rng.randint(0, max(0, len(t) - 30)),)] + [("s99", texts[0]), ("s98", "x" * 40), ("s97", "x" * 24), ("s96", None)]
    long = [(f"l{i}", t) for i, t in enumerate(texts)] + [("l98", "x" * 300)]
    for a, b in ((short, long), (long, short), (short, long[:0])):
        got = {tuple(r) for r in containment.contained(spark.createDataFrame(a, "id string, key string"), spark.createDataFrame(b, "id string, key string")).collect()}
        assert got == {(i, j, len(x)) for i, x in a for j, y in b if x and y and len(x) >= 24 and x in y}
