"""The ten operators against brute force, round trips and held-out accuracy, and on awkward rows: nulls, empty, long and repeated texts, ties, clashing columns."""

import inspect
import random
import time
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pyarrow.dataset as ds
import pytest
import sentencepiece
from pyspark.sql import functions as F

from folioscope.llm import bin_completion, block_naming, gumbel_pieces, html_crf, langid_ppm, probminhash, quality_ordinal, rpforest, token_rans, url_rules
from folioscope.llm.arrow_text import hashes, mix, utf8, words
from folioscope.llm.scratch import among, components

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, id long, size long, hash string, key string"


def docs(spark, rows):
    return spark.createDataFrame([(i, t, g, "s", 0, -1, -1, "h", "k") for i, t, g in rows], DOCS)


AWKWARD = [(1, "the cat sat on the mat by the door", "en"), (2, None, "en"), (3, "", "en"), (4, " \n\t", None), (None, "the cat sat on the mat by the door", "en"), (5, "the cat sat on the mat by the door", "en"), (5, "the cat sat on the mat by the door", "en"), (6, "x" * 200_000, "en"), (7, "ein Satz über Äpfel " * 20_000, "de"), (8, "日本語 €😀", "ja")]


def test_words_and_components(spark):
    data, offsets = utf8(pa.array(["a b  a", None, "", " c\n", "a"]))
    distinct, at, bounds = words(data, offsets)
    assert [distinct[i].as_py() for i in at] == [b"a", b"b", b"a", b"c", b"a"] and bounds.tolist() == [0, 3, 3, 3, 4, 5]
    rng = random.Random(3)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(170)] + [(7, 7), (None, 3), (400 + 1, 400)] + [(500 + i, 501 + i) for i in range(40)]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a is not None and b is not None:
            a, b = sorted((find(a), find(b)))
            parent[b] = a
    got = {r["id"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: find(x) for x in parent}
    keys = spark.range(0, 1000, 7).toDF("k")
    held = {r["id"] for r in spark.range(1000).filter(among(F.col("id"), keys)).collect()}
    assert set(range(0, 1000, 7)) <= held and len(held) < 300
    assert spark.range(5).filter(among(F.col("id"), keys.limit(0))).count() == 0


def ppm(texts, data, orders=3):
    """Bits of ``data`` in one language, a byte at a time."""
    counts = [defaultdict(Counter) for _ in range(orders + 1)]
    for t in texts:
        for i, b in enumerate(t):
            for k in range(min(i, orders) + 1):
                counts[k][t[i - k : i]][b] += 1
    bits = 0.0
    for i, b in enumerate(data):
        p = 1.0
        for k in range(min(i, orders), -1, -1):
            c = counts[k].get(data[i - k : i])
            if c is None:
                continue
            n, q = sum(c.values()), len(c)
            if b in c:
                p *= c[b] / (n + q)
                break
            p *= q / (n + q)
        else:
            p /= 256
        bits -= np.log2(p)
    return bits


def test_language_codes_equal_brute_force():
    texts = {"x": [b"abracadabra abra", b"cab"], "y": [b"lorem ipsum dolor", "né à l'été".encode()]}
    model = langid_ppm.PpmModel(texts)
    tried = ["abra", "lorem abra", "zé!", "", "dolor ipsum né"]
    got = model.bits(*utf8(pa.array(tried)))
    want = [[ppm(texts[k], t.encode()) for k in ("x", "y")] for t in tried]
    assert np.allclose(got, want, atol=1e-3)
    rng = random.Random(4)
    texts = {k: ["".join(rng.choice(s) for _ in range(rng.randint(0, 400))).encode() for _ in range(20)] for k, s in (("p", "abcdé "), ("q", "cdefg 日"), ("r", "ab"))}
    tried = ["".join(rng.choice("abcdefgé日 z") for _ in range(60)) for _ in range(20)]
    got = langid_ppm.PpmModel(texts).bits(*utf8(pa.array(tried)))
    assert np.allclose(got, [[ppm(texts[k], t.encode()) for k in "pqr"] for t in tried], atol=1e-2)


def test_language_held_out_and_awkward(spark):
    table = spark.read.parquet(f"{SF}/documents.parquet")
    held = F.pmod(F.col("doc_id"), F.lit(3)) == 0
    model = langid_ppm.fit(table.filter(~held))
    found = langid_ppm.identify(table.filter(held), model).join(table, "doc_id").agg(F.avg((F.col("language") == F.col("lang")).cast("int")), F.avg(F.col("accepted").cast("int"))).first()
    assert found[0] > 0.95 and found[1] > 0.95
    odd = docs(spark, AWKWARD)
    rows = langid_ppm.identify(odd, model).collect()
    assert len(rows) == len(AWKWARD)
    assert all((r["language"], r["bits_per_byte"], r["accepted"]) == ("und", None, False) for r in rows if r["doc_id"] in (2, 3))
    kept = langid_ppm.accepted_documents(odd, model)
    assert kept.columns == odd.columns and {r["doc_id"] for r in kept.collect()} >= {1, 5, None} and kept.filter("doc_id IN (2, 3)").count() == 0
    told = table.filter(held).filter("n_chars > 1500").limit(40)
    wrong = told.withColumn("lang", F.when(F.col("doc_id") % 2 == 0, F.when(F.col("lang") == "en", "de").otherwise("en")).otherwise(F.when(F.col("doc_id") % 5 == 0, F.lit(None)).otherwise(F.col("lang"))))
    both = lambda df: {r["doc_id"] for r in langid_ppm.accepted_documents(df, model).collect()}
    right = both(told)
    assert both(wrong) == {i for i in right if i % 2} and len(right) > 30 and both(wrong.drop("lang")) == right and both(wrong.withColumn("lang", F.lit("xx"))) == right
    none = langid_ppm.fit(odd.limit(0))
    assert {r["language"] for r in langid_ppm.identify(odd, none).collect()} == {"und"} and langid_ppm.identify(odd.limit(0), model).count() == 0


def test_url_rules(spark):
    rng = random.Random(5)
    labels = ["a", "b", "c", "com", "org"]
    host = lambda: ".".join(rng.choice(labels) for _ in range(rng.randint(1, 4)))
    path = lambda: "".join("/" + rng.choice("xyz") for _ in range(rng.randint(0, 4)))
    pages = [(i, rng.choice(["http://", "HTTPS://www.", "//u@"]) + host() + rng.choice(["", ":80", "."]) + path() + rng.choice(["", "?q=/x", "#f"])) for i in range(400)] + [(400, None), (401, ""), (402, "http:///x"), (5, "http://a.com"), (403, "http://a.com/" + "x/" * 20_000)] + [(500 + i % 90, "http://c.com/x/y") for i in range(200)]
    rules = [(i, host() + path() if i % 2 else host(), f"act{i % 3}") for i in range(60)] + [(99, None, "deny"), (98, "", "deny"), (60, "com", "deny"), (61, "COM", "allow"), (62, "c.com/x/y", "act0"), (63, "c.com/x/yz", "act1")]
    table = spark.createDataFrame([(i, u, "r", "k") for i, u in pages], "page_id long, url string, range string, key string")
    given = url_rules.rules_table(spark, rules)
    got = url_rules.matched(table, given, ranges=7).collect()
    keyed = {(r["page_id"], r["url"]): r["k"] for r in table.select("page_id", "url", url_rules.canonical_key(F.col("url")).alias("k")).collect()}
    prefixes = {}
    for r in given.select("rule_id", "action", url_rules.rule_key(F.col("rule")).alias("k")).orderBy("rule_id").collect():
        if r["k"]:
            prefixes.setdefault(r["k"], (r["rule_id"], r["action"]))
    want = []
    for p in pages:
        k = keyed[p]
        hits = [x for x in prefixes if k and k.startswith(x)]
        top = max(hits, key=len, default=None)
        want.append((p[0], k, *(prefixes[top] if top else (None, "allow")), len(hits)))
    order = lambda rows: sorted(map(str, map(tuple, rows)))
    assert order(got) == order(want) and any(w[2] for w in want)
    assert url_rules.matched(table.limit(0), given).count() == 0 and url_rules.matched(table, given.limit(0)).filter("rule_id IS NOT NULL").count() == 0


def test_quality(spark):
    rng = random.Random(1)
    word = lambda: "".join(rng.choice("etaoin") for _ in range(rng.randint(2, 7)))
    rows, labels = [], []
    for i in range(500):
        body, kind = [word() for _ in range(rng.randint(20, 120))], i % 5
        if kind == 0:
            body = [w + "$$$" for w in body]
        elif kind == 1:
            body[3] = "vile"
        rows.append((i, " ".join(body), "en"))
        labels.append((i, int(kind != 0), int(kind == 1)))
    table, rated = docs(spark, rows), spark.createDataFrame([*labels, (None, 1, 0), (7, None, 0)], "doc_id long, quality int, toxic int")
    grades = quality_ordinal.graded(rated)
    model = quality_ordinal.fit(table, grades.filter("doc_id < 300"))
    assert model.thresholds[0] < model.thresholds[1]
    held = quality_ordinal.rate(table.filter("doc_id >= 300"), model).join(grades, "doc_id").collect()
    assert np.mean([(r["tail"] >= 0.5) == (r["grade"] == 2) for r in held]) > 0.95
    mean = [np.mean([r["expected_grade"] for r in held if r["grade"] == g]) for g in (0, 1, 2)]
    assert mean[0] < mean[1] < mean[2]
    odd = docs(spark, AWKWARD)
    out = quality_ordinal.rate(odd, model).collect()
    assert len(out) == len(AWKWARD) and all(r["tail"] is None and not r["accepted"] for r in out if r["doc_id"] in (2, 3))
    assert quality_ordinal.accepted_documents(odd, model).columns == odd.columns
    free = quality_ordinal.fit(table, grades.limit(0))
    assert quality_ordinal.rate(table, free).filter("accepted").count() == 500


def rating_features(text):
    """Words, endings and shares of one text, a word at a time."""
    count = words_seen = 0
    shares, words_ = np.zeros(quality_ordinal.SHARES), set()
    last = None
    one = lambda x: int(hashes(pa.array([x]))[0])
    for w in (text or "").encode().split():
        word = w.decode()
        count += 1
        core = word.strip(quality_ordinal._PUNCT)
        words_.add(one(core.lower()) >> (64 - quality_ordinal.BITS))
        ending = word[len(word.rstrip(quality_ordinal._PUNCT)) :]
        if ending:
            shares[one(ending) % (quality_ordinal.SHARES - 3)] += 1
        shares[quality_ordinal.SHARES - 3] += word == last
        shares[quality_ordinal.SHARES - 2] += core.isupper() and len(core) > 1
        shares[quality_ordinal.SHARES - 1] += core == ""
        last = word
    return words_, np.sqrt(shares / max(1, count))


def test_quality_features_and_rates(spark):
    """Features and figures against ones worked out a word at a time; ids may be strings."""
    rng = random.Random(2)
    tried = [" ".join(rng.choice(["the", "The", "CAT", "cat.", "«mat»", "x", "!!!", "A", "ÉTÉ", "don't", "end?!", "--", "7"]) for _ in range(rng.randint(0, 40))) for _ in range(60)] + ["", None, " \n\t ", "word " * 5000]
    idx, bounds, shares = quality_ordinal.features(*utf8(pa.array(tried)))
    for i, t in enumerate(tried):
        want, own = rating_features(t)
        assert set(idx[bounds[i] : bounds[i + 1]].tolist()) == want and bounds[i + 1] - bounds[i] == len(want) and np.allclose(shares[i], own)
    weights = np.random.default_rng(3).standard_normal(1 << quality_ordinal.BITS).astype(np.float32)
    model = quality_ordinal.OrdinalModel(weights, np.random.default_rng(4).standard_normal(quality_ordinal.SHARES), np.array([-0.5, 0.4]))
    table = spark.createDataFrame([(f"d{i}", t, 1.0, 2) for i, t in enumerate(tried)], "doc_id string, text string, tail double, rated int")
    got = {r["doc_id"]: r for r in quality_ordinal.rate(table, model, least_tail=0.5).collect()}
    for i, t in enumerate(tried):
        words_, own = rating_features(t)
        score = sum(float(weights[w]) for w in words_) * (quality_ordinal.PLENTY / max(len(words_), quality_ordinal.PLENTY)) ** 0.5 + own @ model.share
        tails = [1 / (1 + np.exp(x - score)) for x in model.thresholds]
        r = got[f"d{i}"]
        if not t:
            assert r["tail"] is None and r["expected_grade"] is None and not r["accepted"]
        else:
            assert abs(r["tail"] - tails[1]) < 1e-5 and abs(r["expected_grade"] - sum(tails)) < 1e-5 and r["accepted"] == (r["tail"] >= 0.5)
    kept = quality_ordinal.accepted_documents(table, model, least_tail=0.5)
    assert kept.schema == table.schema and {r["doc_id"] for r in kept.collect()} == {k for k, r in got.items() if r["accepted"]}
    rated = spark.createDataFrame([(f"d{i}", i % 3) for i in range(60)], "doc_id string, grade int")
    assert (np.diff(quality_ordinal.fit(table, rated).thresholds) > 0).all()


def test_quality_of_toxic_rows():
    """Held-out toxic rows of good quality, few words of which are toxic, are rejected by default, and good and clean ones aren't."""
    table = lambda name, *columns: ds.dataset(f"/root/testdata/sf0.1/{name}.parquet").to_table(columns=list(columns))
    rows = table("labels", "doc_id", "quality", "toxic").join(table("documents", "doc_id", "text"), "doc_id", join_type="inner").sort_by("doc_id")
    rows = rows.take(np.random.default_rng(0).permutation(len(rows))).combine_chunks()
    grade = np.where(rows["quality"].to_numpy() < 1, 0, np.where(rows["toxic"].to_numpy() > 0, 1, 2))
    model = quality_ordinal.fit_arrays(*quality_ordinal.features(*utf8(rows["text"].chunk(0)[:2000])), grade[:2000], 3)
    least = inspect.signature(quality_ordinal.rate).parameters["least_tail"].default
    tail = model.tails(model.score(*quality_ordinal.features(*utf8(rows["text"].chunk(0)[2000:]))))[:, -1]
    rejected = [(tail[grade[2000:] == g] < least).mean() for g in range(3)]
    assert rejected[0] > 0.98 and rejected[1] > 0.7 and rejected[2] < 0.02


def test_ordinal_gradient():
    rng = np.random.default_rng(0)
    idx, bounds = np.arange(40) % 7, np.arange(0, 41, 4)
    shares, grade = rng.random((10, quality_ordinal.SHARES)), rng.integers(0, 3, 10)
    seen = {}

    def spy(f, x, steps):
        v, g = f(x + 0.1)
        at = [0, 5, len(x) - 2, len(x) - 1]
        for i in at:
            d = np.zeros(len(x))
            d[i] = 1e-5
            seen[i] = abs((f(x + 0.1 + d)[0] - f(x + 0.1 - d)[0]) / 2e-5 - g[i])
        return x

    old, quality_ordinal.minimise = quality_ordinal.minimise, spy
    try:
        quality_ordinal.fit_arrays(idx, bounds, shares, grade, 3)
    finally:
        quality_ordinal.minimise = old
    assert max(seen.values()) < 1e-4


def test_near_duplicates(spark):
    rng = random.Random(2)
    base = [[f"w{rng.randrange(4000)}" for _ in range(rng.randint(30, 150))] for _ in range(60)]
    rows = []
    for i, b in enumerate(base):
        rows.append(" ".join(b))
        for _ in range(i % 4):
            c = list(b)
            for _ in range(max(1, len(c) // rng.choice([12, 20, 40]))):
                c[rng.randrange(len(c))] = f"n{rng.randrange(10**6)}"
            rows.append(" ".join(c))
    big = base[5]
    rows += [" ".join([*big, f"extra{i}"]) for i in range(150)] + [" ".join(base[9])] * 3
    table = docs(spark, [(i, t, "en") for i, t in enumerate(rows)])
    sets = []
    for t in rows:
        text, item, weight = probminhash.shingles(*utf8(pa.array([t])))
        sets.append((item, weight))
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    alike = [(i, j) for i in range(len(rows)) for j in range(i) if probminhash.similarity(sets[i], sets[j]) >= probminhash.THRESHOLD]
    for i, j in alike:
        a, b = sorted((find(i), find(j)))
        parent[b] = a
    got = {r["doc_id"]: r["group_id"] for r in probminhash.near_duplicates(table).collect()}
    assert np.mean([got[i] == got[j] for i, j in alike]) > 0.95
    assert all(find(i) == find(g) for i, g in got.items())
    odd = docs(spark, AWKWARD)
    kept = probminhash.without_near_duplicates(odd)
    assert kept.columns == odd.columns and sorted(r["doc_id"] or 0 for r in kept.collect()) == [0, 1, 2, 3, 4, 6, 7, 8]
    assert probminhash.near_duplicates(odd).count() == len(AWKWARD) and probminhash.near_duplicates(odd.limit(0)).count() == 0


def test_near_duplicates_in_large_buckets(spark):
    """Hundreds of texts share a passage, so that most pairs in a band's buckets of over 64 are in doubt; some pairs are alike."""
    rng = random.Random(4)
    shared = [f"s{i}" for i in range(92)]
    rows = []
    for i in range(300):
        own = [f"o{i}x{j}" for j in range(60)]
        rows += [" ".join([*shared, *own]), " ".join([*shared, *own[:13], *(f"p{i}x{j}" for j in range(47))])]
    rng.shuffle(rows)
    text, item, weight = probminhash.shingles(*utf8(pa.array(rows)))
    at = np.searchsorted(text, np.arange(len(rows) + 1))
    sets = [(item[i:j], weight[i:j]) for i, j in zip(at, at[1:])]
    sig = probminhash.signatures(text, item, weight, len(rows))
    bands = [defaultdict(list) for _ in range(probminhash.COMPONENTS // probminhash.ROWS)]
    for i, s in enumerate(sig):
        for j, bucket in enumerate(bands):
            bucket[s[j * probminhash.ROWS : (j + 1) * probminhash.ROWS].tobytes()].append(i)
    assert max(len(x) for b in bands for x in b.values()) > probminhash.PAIRWISE
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    low, high = probminhash.THRESHOLD - probminhash.DOUBT, probminhash.THRESHOLD + probminhash.DOUBT
    for a, b in {(a, b) for bucket in bands for x in bucket.values() for k, a in enumerate(x) for b in x[k + 1 :]}:
        estimate = (sig[a] == sig[b]).mean()
        if estimate >= high or estimate >= low and probminhash.similarity(sets[a], sets[b]) >= probminhash.THRESHOLD:
            x, y = sorted((find(a), find(b)))
            parent[y] = x
    for block in (probminhash.BLOCK, 50):
        got = {r["doc_id"]: r["group_id"] for r in probminhash.near_duplicates(docs(spark, [(i, t, "en") for i, t in enumerate(rows)]), block=block).collect()}
        assert got == {i: find(i) for i in range(len(rows))}
    assert 200 < len(set(got.values())) < 500


def test_near_duplicates_of_other_ids_and_scripts(spark):
    """Ids that are strings, columns of names that the operator uses, texts without spaces, and a long one."""
    rng = random.Random(8)
    han = lambda: [chr(rng.randrange(0x4E00, 0x9000)) for _ in range(200)]
    base = [han(), han(), [f"w{rng.randrange(9**9)} " for _ in range(60_000)]]
    rows = [(f"x{k}{j}", "".join([*b[: len(b) // 2], str(j), *b[len(b) // 2 :]])) for k, b in enumerate(base) for j in range(3)] + [("y", "".join(han())), (None, rows_text := "".join(base[0])), ("z", ""), ("y", rows_text)]
    names = "_gone near_copy near_copy_ id key whole bands sig group_id copies kept member".split()
    table = spark.createDataFrame([(i, t, *names) for i, t in rows], "doc_id string, text string, " + ", ".join(f"`{c}` string" for c in names))
    got = {r["doc_id"]: r["group_id"] for r in probminhash.near_duplicates(table).collect()}
    # the second text of y is a copy of the first group's
    assert got == {f"x{k}{j}": f"x{k}0" for k in range(3) for j in range(3)} | {"y": "x00", "z": "z", None: None}
    kept = probminhash.without_near_duplicates(table)
    assert kept.schema == table.schema and sorted(r["doc_id"] or "" for r in kept.collect()) == ["", "x00", "x10", "x20", "z"]


def test_similarity_and_signatures():
    rng = np.random.default_rng(1)
    items = np.arange(500, dtype=np.uint64)
    a, b = (items[:300], rng.integers(1, 5, 300)), (items[80:380], rng.integers(1, 5, 300))
    x, y = dict(zip(a[0].tolist(), a[1].tolist())), dict(zip(b[0].tolist(), b[1].tolist()))
    every = set(x) | set(y)
    want = sum(1 / sum(max(x.get(k, 0) / x[d], y.get(k, 0) / y[d]) for k in every) for d in x if d in y)
    assert abs(probminhash.similarity(a, b) - want) < 1e-9
    sig = probminhash.signatures(np.repeat([0, 1], 300), np.concatenate([a[0], b[0]]), np.concatenate([a[1], b[1]]), 2, 4096)
    assert abs((sig[0] == sig[1]).mean() - want) < 0.03


def test_token_round_trip(spark):
    table = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").union(docs(spark, AWKWARD).select("doc_id", "text"))
    out = token_rans.encoded(table.withColumn("ids", F.lit(1)), block=256).cache()
    encoding = token_rans.tokenizer()
    want = sorted(str((r["doc_id"], None if r["text"] is None else encoding.encode_ordinary(r["text"]))) for r in table.collect())
    assert sorted(str((r["doc_id"], r["ids"])) for r in token_rans.decoded(out, block=256).collect()) == want
    head = out.filter("n_tokens < 0").collect()
    assert len(head) == 1 and out.count() == table.count() + 1
    spoiled = out.withColumn("payload", F.when(F.col("n_tokens") > 50, F.expr("concat(substring(payload, 1, 40), X'00', substring(payload, 42, length(payload)))")).otherwise(F.col("payload")))
    with pytest.raises(Exception):
        token_rans.decoded(spoiled, block=256).collect()
    assert token_rans.encoded(table.limit(0)).count() == 1


def test_frequencies():
    t = token_rans.Frequencies(np.array([10**9, 0, 1, 1] + [1] * 1000))
    assert t.freq.sum() == 1 << token_rans.SCALE and t.freq[1] == 0 and (t.freq[[0, *range(2, 1004)]] > 0).all()
    back = token_rans.Frequencies.unpacked(t.packed())
    assert (back.freq == t.freq).all() and (back.start == t.start).all()


HTML = "<html><head><title>T</title><script>var a='<p>no</p>'</script></head><body><nav><ul><li><a href=x>Home</a><li><a href=y>More</a></ul></nav><div class='main art'><p>One &amp; two words.<p>Then <b>bold</b> text<br>here.</div><!-- <p>gone</p> --><footer>c</footer>"


def test_html(spark):
    page = html_crf.blocks(HTML)
    feats = page.features()
    assert page.texts == ["Home", "More", "One & two words.", "Then bold text here.", "c"] and len(feats) == 5
    assert page.size() == sum(map(len, feats)) and len(set(feats[2]) & {html_crf._code(f"in {x}") for x in ("div", "div.main", "div.art", "body", "p")}) == 5
    for odd in ("", "plain", "<", "<p", "</p></div>", "<p>" * 3000 + "x", "<!-- open", "<script>x", "a<b>c"):
        html_crf.blocks(odd)
    pages, table = spark.read.parquet(f"{SF}/../sf0.01/pages.parquet"), spark.read.parquet(f"{SF}/../sf0.01/documents.parquet")
    held = F.pmod(F.col("page_id"), F.lit(3)) == 0
    model = html_crf.fit(html_crf.labelled_pages(pages.filter(~held), table))
    right = total = 0
    for r in html_crf.labelled_pages(pages.filter(held), table).collect():
        page = html_crf.blocks(r["html"])
        want = html_crf.label(page.texts, r["document"])
        assert model.labels(page) == model.decode(page.features())
        if sum(want):
            right += sum(a == b for a, b in zip(want, model.labels(page)))
            total += len(want)
    assert total > 200 and right / total > 0.97
    odd = spark.createDataFrame([(1, None, "t"), (2, "", "t"), (3, HTML, "t"), (3, HTML, "t"), (None, "<p>a b c", "t")], "page_id long, html string, text string")
    rows = html_crf.extracted(odd, model).collect()
    assert [r["text"] for r in rows if r["page_id"] in (1, 2)] == [None, ""] and len(rows) == 5
    assert html_crf.extracted(odd.limit(0), model).count() == 0 and html_crf.fit(html_crf.labelled_pages(pages.limit(0), table)).decode(feats)


@pytest.mark.parametrize("unit", ["<a ", "<a '", "<a \"<x>\" ", "<a \">\" ", "<a x='>\" ", "<div class=c{}>x ", "<!-", "<script>", "&lt;<p>y</b>", "<a href=\"x>"])
def test_html_of_a_megabyte(unit):
    """Malformed pages take time in proportion to their length."""
    html = "<p>begin</p>" + "".join(unit.format(i) for i in range(1_000_000 // len(unit))) + " end"
    began = time.process_time()
    page = html_crf.blocks(html)
    html_crf.ChainField(np.zeros((1 << html_crf.BITS, 2)), np.zeros((2, 2))).labels(page)
    assert time.process_time() - began < 20 and page.texts[0] == "begin"


def test_tag_ends():
    """Against a search from each place."""
    rng = random.Random(3)

    def end(html, i):
        while i < len(html):
            if html[i] == ">":
                return i
            if html[i] in "\"'" and html.find(html[i], i + 1) >= 0:
                i = html.find(html[i], i + 1)
            i += 1
        return -1

    for _ in range(2000):
        html = "".join(rng.choice("><a\"' ") for _ in range(rng.randint(0, 30)))
        ends = html_crf._Ends(html)
        assert [ends.behind(i) for i in range(len(html) + 1)] == [end(html, i) for i in range(len(html) + 1)]


def test_viterbi_and_gradient():
    rng = np.random.default_rng(3)
    weight, step = rng.standard_normal((1 << html_crf.BITS, 2)), rng.standard_normal((2, 2))
    field = html_crf.ChainField(weight, step)
    feats = [[int(x) for x in rng.integers(0, 50, 4)] for _ in range(7)]
    score = lambda y: sum(weight[f, v].sum() for f, v in zip(feats, y)) + sum(step[a, b] for a, b in zip(y, y[1:]))
    best = max(([k >> i & 1 for i in range(7)] for k in range(128)), key=score)
    assert field.decode(feats) == best


def test_chain_likelihood(monkeypatch):
    """The training's value and gradient against sums over all labellings of small pages."""
    rng = np.random.default_rng(5)
    pages = [([[int(x) for x in rng.integers(0, 6, rng.integers(1, 4))] for _ in range(n)], [int(x) for x in rng.integers(0, 2, n)]) for n in (1, 4, 2, 5)]
    seen = {}

    def spy(f, x, steps):
        x = rng.standard_normal(len(x))
        seen["value"], seen["grad"] = f(x)
        seen["x"] = x
        seen["numeric"] = np.array([(f(x + d)[0] - f(x - d)[0]) / 2e-5 for d in np.eye(len(x)) * 1e-5])
        return x

    monkeypatch.setattr(html_crf, "minimise", spy)
    field = html_crf.fit_pages(pages, l2=0.3)
    total = 0.3 / 2 * (seen["x"] ** 2).sum()
    for feats, y in pages:
        score = lambda z: sum(field.weight[f, v].sum() for f, v in zip(feats, z)) + sum(field.step[a, b] for a, b in zip(z, z[1:]))  # noqa: B023, E731
        total += np.log(sum(np.exp(score([k >> i & 1 for i in range(len(y))])) for k in range(1 << len(y)))) - score(y)
    assert abs(total - seen["value"]) < 1e-8 and np.abs(seen["numeric"] - seen["grad"]).max() < 1e-5


def test_embeddings(spark):
    rng = np.random.default_rng(4)
    centre = rng.standard_normal((150, 16))
    rows = [(i, c.tolist()) for i, c in enumerate(centre)] + [(1000 + i, (centre[i % 40] + 0.02 * rng.standard_normal(16)).tolist()) for i in range(200)] + [(2000 + i, centre[3].tolist()) for i in range(50)]
    odd = [(5000, None), (5001, [0.0] * 16), (5002, [1.0] * 15), (5003, [float("nan")] * 16), (5004, [None] * 16), (None, [1.0] * 16)]
    table = spark.createDataFrame([(i, v, 1, 2) for i, v in rows + odd], "vec_id long, embedding array<double>, label int, leaf int")
    found = {name: {r["vec_id"]: r["group_id"] for r in rpforest.groups(table, leaf=32, **more).collect()} for name, more in (("whole", {}), ("rounds", {"top": 1, "held": 20}))}
    got = found["whole"]
    x = np.array([v for _, v in rows])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    i, j = np.nonzero(np.triu(x @ x.T >= rpforest.THRESHOLD, 1))
    ids = [k for k, _ in rows]
    for x in found.values():
        assert np.mean([x[ids[a]] == x[ids[b]] for a, b in zip(i, j)]) > 0.95
    parent = {k: k for k in ids}

    def find(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for a, b in zip(i, j):
        a, b = sorted((find(ids[a]), find(ids[b])))
        parent[b] = a
    for x in found.values():
        assert all(find(k) == find(g) for k, g in x.items() if k in parent)
        assert all(x[k] == k for k in range(5000, 5005)) and None not in x
    assert rpforest.groups(table.limit(0)).count() == 0
    named = table.filter("vec_id is null or vec_id < 1010").select(F.concat(F.lit("v"), F.lpad(F.col("vec_id").cast("string"), 6, "0")).alias("vec_id"), "embedding", *[F.lit(1).alias(c) for c in ("id", "tree", "v", "low", "member", "group_id")])
    assert {r["vec_id"]: r["group_id"] for r in rpforest.groups(named, leaf=32).collect()} == {f"v{k:06d}": f"v{g:06d}" for k, g in got.items() if k < 1010}


def test_embeddings_recall():
    """Of the pairs that a forest should find among many near copies nine in ten meet in a leaf, whether the driver or the tasks cut the trees."""
    rng = np.random.default_rng(6)
    x = rng.standard_normal((6000, 48)).astype(np.float32)
    x[3000:] = x[:3000] + 0.3 * rng.standard_normal((3000, 48)).astype(np.float32)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    near = np.flatnonzero((x[:3000] * x[3000:]).sum(1) >= rpforest.THRESHOLD)
    ways = rpforest.directions(rpforest.TREES, 5, 48)
    met = np.zeros(3000, bool)
    for t in range(rpforest.TREES):
        cuts = rpforest.Cuts(x[::3], ways[t])
        rows, node = np.arange(6000), np.ones(6000, np.int64)
        for level in range(5):
            rows, node = rpforest.halves(rows, node, x[rows] @ ways[t, level], cuts.low[node], cuts.high[node])
        assert np.bincount(node).max() < 6000 / 32 * 2.5 and len(set(rows)) == 6000
        pairs = set(zip(rows.tolist(), node.tolist()))
        met |= np.array([any((k + 3000, n) in pairs for n in range(32, 64) if (k, n) in pairs) for k in range(3000)])
    assert len(near) > 200 and met[near].mean() >= 0.9
    parts = rpforest.leaves(x, 400)
    assert max(map(len, parts)) <= 400 and set(np.concatenate(parts)) == set(range(6000))
    assert [len(p) for p in rpforest.leaves(np.ones((900, 4), np.float32), 100)] == [900]


def test_linked_is_exact():
    rng = np.random.default_rng(8)
    x = rng.standard_normal((900, 4)).astype(np.float32)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    ids = np.arange(900)

    def roots(a, b):
        parent = list(range(900))

        def find(k):
            while parent[k] != k:
                k = parent[k]
            return k

        for p, q in zip(a, b):
            p, q = sorted((find(p), find(q)))
            parent[q] = p
        return [find(k) for k in range(900)]

    assert roots(*rpforest.linked(ids, x, 0.995, leaf=64)) == roots(*np.nonzero(np.triu(x @ x.T >= 0.995, 1)))


def test_packing(spark):
    rng = random.Random(6)
    for sizes, cap in [([25, 43, 56, 44, 17, 56, 16, 25, 30, 60, 15, 60], 150), *((([rng.randint(low, high) for _ in range(rng.randint(10, 14))]), cap) for cap, low, high in 5 * ((20, 3, 20), (150, 15, 60), (150, 8, 105), (1000, 50, 400), (50, 5, 35)) for _ in range(40))]:
        bins, proved = bin_completion.searched(sizes, cap)
        assert sorted(i for b in bins for i in b) == list(range(len(sizes))) and all(sum(sizes[i] for i in b) <= cap for b in bins)
        assert proved and len(bins) == least_bins(sizes, cap) >= bin_completion.least_bins(sizes, cap)
    many = bin_completion.pack([5000] * 3 + [1] * 1384, 8192)
    assert len(many) == 3 and sorted(i for b in many for i in b) == list(range(1387))
    assert max(len(b) for b in bin_completion.pack([8191, 8191, 8190, *[1] * 5000], 8192)) > 4000
    sizes = [rng.randint(1, 8192) for _ in range(3000)]
    bins, _ = bin_completion.searched(sizes, 8192, 300)
    assert len(bins) <= len(bin_completion.best_fit(sizes, 8192)) and sorted(i for b in bins for i in b) == list(range(3000))
    odd = docs(spark, AWKWARD)
    rows = bin_completion.packed(odd, capacity=1000, shard=4).collect()
    fill, spans = Counter(), defaultdict(list)
    for r in rows:
        fill[r["bin"]] += r["length"]
        spans[r["doc_id"]].append((r["start"], r["length"]))
    assert all(v <= 1000 for k, v in fill.items() if k is not None) and spans[2] == [(0, 0)] and spans[3] == [(0, 0)]
    assert sorted(spans[6]) == [(k, 1000) for k in range(0, 200_000, 1000)] and len(spans[5]) == 2
    assert bin_completion.packed(odd.limit(0)).count() == 0
    short = spark.range(1400).select(F.col("id").cast("string").alias("doc_id"), F.expr("repeat('x', CASE WHEN id < 3 THEN 5000 ELSE 1 END)").alias("text"), F.lit(1).alias("shard"), F.lit(1).alias("bin"))
    rows = bin_completion.packed(short).collect()
    assert len(rows) == 1400 and {r["doc_id"] for r in rows} == {str(i) for i in range(1400)} and len({r["bin"] for r in rows}) == 3


def test_fillings():
    """All undominated fillings and no others, against every multiset."""
    rng = random.Random(11)
    for _ in range(200):
        rest, room = sorted(rng.randint(1, 12) for _ in range(rng.randint(0, 8))), rng.randint(0, 25)
        sets = {tuple(sorted((rest[i] for i in range(len(rest)) if k >> i & 1), reverse=True)) for k in range(1 << len(rest))}
        sets = {s for s in sets if sum(s) <= room}

        def worse(s):
            left = Counter(rest)
            left.subtract(s)
            parts = [p for k in range(1 << len(s)) if (p := [s[i] for i in range(len(s)) if k >> i & 1]) or k == 0]
            return any(n > 0 and any(sum(p) <= x <= sum(p) + room - sum(s) and p != [x] for p in parts) for x, n in left.items())

        got = list(bin_completion.fillings(room, rest, room, [10**6]))
        assert len(got) == len(set(got)) and set(got) == {s for s in sets if not worse(s)}


def least_bins(sizes, cap):
    best = [len(sizes)]
    sizes = sorted(sizes, reverse=True)

    def put(i, bins):
        if len(bins) + max(0, -(-(sum(sizes[i:]) - sum(bins)) // cap)) >= best[0]:
            return
        if i == len(sizes):
            best[0] = len(bins)
            return
        for r in set(bins):
            if r >= sizes[i]:
                rest = list(bins)
                rest.remove(r)
                put(i + 1, [*rest, r - sizes[i]])
        put(i + 1, [*bins, cap - sizes[i]])

    put(0, [])
    return best[0]


def test_sampled_pieces(spark):
    pieces = gumbel_pieces.Pieces()
    n = 3000
    got = gumbel_pieces.sample_batch(pieces, *utf8(pa.array(["them"] * n)), mix(np.arange(n).astype(np.uint64)), 2)
    chance = {tuple(s[0].tolist()): np.exp(s[1]) for x in got for s in x}
    assert abs(sum(chance.values()) - 1) < 0.01
    first, second = (Counter(tuple(x[k][0].tolist()) for x in got) for k in (0, 1))
    for way, p in chance.items():
        assert abs(first[way] / n - p) < 0.03
        assert abs(second[way] / n - sum(q * p / (1 - q) for w, q in chance.items() if w != way)) < 0.03
    for k in (1, 3, 4):
        assert_inclusion(pieces, "abc", k)
    odd = docs(spark, AWKWARD)
    rows = gumbel_pieces.decoded(gumbel_pieces.sampled(odd, k=3)).join(odd.select(F.col("doc_id").alias("d"), F.col("text").alias("t")).distinct(), F.col("doc_id") == F.col("d")).collect()
    assert all(r["decoded"] == r["t"] and r["restored"] is (None if r["t"] is None else True) for r in rows)
    sp = sentencepiece.SentencePieceProcessor(model_file=gumbel_pieces.MODEL)
    assert all(r["ids"] is None or sp.decode(r["ids"]) == r["t"] for r in rows)
    odd_ids = spark.createDataFrame([([5000, 9, 1, 2, 31000],), ([],), (None,), ([260, 3, 400],)], "ids array<int>")
    assert [r["decoded"] for r in gumbel_pieces.decoded(odd_ids).collect()] == [None if r["ids"] is None else sp.decode(r["ids"]) for r in odd_ids.collect()]
    ways = defaultdict(list)
    for r in rows:
        ways[r["doc_id"]].append(tuple(r["ids"] or ()))
        assert r["log_inclusion"] is None or -np.inf < r["log_inclusion"] <= 0
    assert len(set(ways[1])) == 3 and ways[3] == [()] and ways[2] == [()] and len(ways[5]) == 6
    again = gumbel_pieces.sampled(odd.repartition(3), k=3).filter("doc_id = 1").orderBy("sample").collect()
    assert [tuple(r["ids"]) for r in again] == [w for _, w in sorted((r["sample"], tuple(r["ids"])) for r in rows if r["doc_id"] == 1)]
    assert gumbel_pieces.sampled(odd.limit(0)).count() == 0


def segmentations(pieces, text):
    """Every segmentation's edges and probability, listed."""
    lattice = gumbel_pieces.Lattice(pieces, *gumbel_pieces.parts(*utf8(pa.array([text])))[:2])
    edges = [(int(a), int(b), float(lattice.log[e])) for e, (a, b) in enumerate(zip(lattice.start, lattice.stop))]
    ways = [((), 0, 0.0)]
    done = {}
    while ways:
        way, at, log = ways.pop()
        for e, (a, b, x) in enumerate(edges):
            if a == at:
                if lattice.last[e]:
                    done[(*way, e)] = log + x
                else:
                    ways.append(((*way, e), b, log + x))
    return done


def assert_inclusion(pieces, text, k):
    """Weighing each sample by its inclusion probability estimates sums over all segmentations without bias, for any k; k of all of them is a sample of all."""
    n = 4000
    chance = {tuple(x): p for x, p in ((tuple(w), np.exp(v)) for w, v in segmentations(pieces, text).items())}
    assert abs(sum(chance.values()) - 1) < 1e-9
    got = gumbel_pieces.sample_batch(pieces, *utf8(pa.array([text] * n)), mix(np.arange(n).astype(np.uint64) + np.uint64(k)), k)
    assert all(len(x) == min(k, len(chance)) and len({tuple(s[0].tolist()) for s in x}) == len(x) for x in got)
    ones = [sum(np.exp(s[1] - s[3]) for s in x) if len(x) < len(chance) else 1.0 for x in got]
    squares = [sum(np.exp(2 * s[1] - s[3]) for s in x) for x in got]
    want = sum(p * p for p in chance.values())
    for estimates, truth in ((ones, 1.0), (squares, want)):
        assert abs(np.mean(estimates) - truth) < 5 * np.std(estimates) / n**0.5 + 1e-9
    keys = np.array([[s[2] for s in x] for x in got])
    assert (np.diff(keys, axis=1) <= 0).all()


def test_exact_duplicates(spark):
    rng = random.Random(9)
    texts = ["".join(rng.choice("ab") for _ in range(rng.randint(0, 6))) for _ in range(120)] + ["é" * 50, "é" * 50, "e" * 100, "x" * 64 + "y", "x" * 64 + "z", "x" * 65, None, None]
    rows = [(i % 100, t, "en") for i, t in enumerate(texts)]
    table = docs(spark, rows)
    got = Counter((r["doc_id"], r["keep_id"], r["copies"]) for r in block_naming.duplicates(table, block=2).collect())
    n, least = Counter(texts), {}
    for i, t, _ in rows:
        least[t] = min(least.get(t, i), i)
    assert got == Counter((i, i if t is None else least[t], 1 if t is None else n[t]) for i, t, _ in rows)
    kept = block_naming.without_copies(table, block=2)
    assert kept.columns == table.columns
    assert Counter((r["doc_id"], r["text"]) for r in kept.collect()) == Counter({(least[t], t): 1 for t in n if t is not None} | {(i, None): 1 for i, t, _ in rows if t is None})
    odd = docs(spark, AWKWARD)
    assert sorted(r["doc_id"] or 0 for r in block_naming.without_copies(odd).collect()) == [1, 2, 3, 4, 6, 7, 8]
    assert block_naming.duplicates(odd.limit(0)).count() == 0 and block_naming.without_copies(odd.limit(0)).count() == 0
    named = block_naming.identities(table, block=2).collect()
    assert len(named) == sum(t is not None for t in texts) and len({(r["level"], r["name"]) for r in named}) == len(n) - 1


def test_exact_duplicates_of_long_texts_and_clashing_columns(spark):
    rng = random.Random(12)
    head = "".join(rng.choice("abcdefgh ") for _ in range(9000))
    long = [head + str(i % 7) + "z" * (5000 * (i % 3)) for i in range(60)]  # 21 texts that share more than two whole blocks
    names = "_hash _size _i _s _h _place block_prints block_prints_ row key level name n a b p part".split()
    rows = [(f"d{i % 50:02d}", t, *[f"{c}{i % 50}" for c in names], {"k": i}) for i, t in enumerate(long + long[:20])]
    table = spark.createDataFrame(rows, "doc_id string, text string, " + ", ".join(f"`{c}` string" for c in names) + ", extra map<string,int>")
    least, n = {}, Counter(r[1] for r in rows)
    for r in rows:
        least[r[1]] = min(least.get(r[1], r[0]), r[0])
    assert Counter(map(tuple, block_naming.duplicates(table).collect())) == Counter((r[0], least[r[1]], n[r[1]]) for r in rows)
    kept = block_naming.without_copies(table)
    got = kept.collect()
    assert kept.schema == table.schema and sorted((r["doc_id"], r["text"]) for r in got) == sorted((v, k) for k, v in least.items())
    assert all(r["_hash"] == f"_hash{int(r['doc_id'][1:])}" and r["extra"] for r in got)
