"""Corpus operators against brute force, and their edges."""

import base64
import hashlib
import itertools
import json
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from reelspan.llm import byte_bpe, chat_format, components, exact_dedup, fingerprints, html_extract, near_dedup, packing, runtime, substring_dedup, token_counts, toxicity

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
WORD = public_tokenizers.path("word_bpe_49k.json")
BYTE = public_tokenizers.path("byte_bpe_50k.tiktoken")


def words(n, seed):
    r = random.Random(seed)
    return [r.choice("alpha beta gamma delta eps zeta eta theta iota kappa".split()) + str(r.randrange(50)) for _ in range(n)]


def awkward(spark):
    """Nulls, empty, very long and repeated texts, ties, and columns with clashing names."""
    base = words(120, 1)
    near = base[:60] + ["changed"] + base[61:]
    long = " ".join(words(30_000, 2))
    rows = [(1, " ".join(base)), (2, " ".join(base)), (3, " ".join(near)), (4, None), (5, ""), (6, "a b"), (7, "A  b"), (8, long), (9, " ".join(words(40, 3) + base[10:80])), (10, "\u00e9t\u00e9 \U0001f600\x00 <|endoftext|> it's 12  \n"), (11, "   "), (12, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for c in ("digest", "kept", "keep_id", "_id", "_gone", "component", "block", "n_tokens", "length", "score"):
        df = df.withColumn(c, F.lit("x"))
    return df, dict(rows)


def empty(spark):
    return spark.createDataFrame([], DOCS)


def test_exact(spark):
    df, rows = awkward(spark)
    got = {r["doc_id"]: r for r in exact_dedup.exact_duplicates(df, counters=1).collect()}
    for i, t in rows.items():
        same = [j for j, u in rows.items() if (u or "") == (t or "")]
        assert (got[i]["keep_id"], got[i]["group_size"], got[i]["kept"]) == (max(same), len(same), i == max(same))
        assert got[i]["text_sha256"] == hashlib.sha256((t or "").encode()).hexdigest()
    kept = exact_dedup.drop_exact_duplicates(df)
    assert kept.columns == df.columns and {r["doc_id"] for r in kept.collect()} == {2, 3, 6, 7, 8, 9, 10, 11, 12}
    assert exact_dedup.exact_duplicates(empty(spark)).count() == 0
    twice = spark.createDataFrame([(None, "x"), (None, "x"), (7, "x"), (7, "x")], "doc_id long, text string")
    assert sorted(r["kept"] for r in exact_dedup.exact_duplicates(twice).collect()) == [False, False, True, True]


def test_misra_gries_finds_every_heavy_digest(spark):
    r = random.Random(5)
    keys = ["h1"] * 400 + ["h2"] * 250 + [f"k{i}" for i in range(700)]
    r.shuffle(keys)
    keyed = spark.createDataFrame(list(enumerate(keys)), "doc_id long, digest string")
    got = {x["digest"]: x["group_size"] for x in exact_dedup.heavy_hitters(keyed, 9).collect()}
    assert got == {"h1": 400, "h2": 250}


@pytest.mark.parametrize("hot", [substring_dedup.HOT, 1])
def test_substring(spark, monkeypatch, hot):
    monkeypatch.setattr(substring_dedup, "HOT", hot)
    df, rows = awkward(spark)
    for window in (5, 13):
        first, got = {}, {r["doc_id"]: r for r in substring_dedup.repeated_passages(df, window).collect()}
        for i in sorted(rows):
            w = re.findall(r"[^\x20\x09-\x0D]+", rows[i] or "")
            stay = [True] * len(w)
            for k in range(len(w) - window + 1):
                if first.setdefault(tuple(w[k : k + window]), i) < i:
                    stay[k : k + window] = [False] * window
            assert got[i]["n_words"] == len(w) and got[i]["n_removed"] == len(w) - sum(stay)
            assert got[i]["kept_text"] == " ".join(a for a, s in zip(w, stay, strict=True) if s)
    out = substring_dedup.drop_repeated_passages(df, 13)
    assert out.columns == df.columns and out.count() == len(rows)
    assert out.filter("doc_id = 7").first()["text"] == "A  b"
    assert substring_dedup.repeated_passages(empty(spark)).count() == 0
    a, b = " ".join(words(20, 31)), " ".join(words(20, 32))
    twice = spark.createDataFrame([(1, a), (2, f"x {a}"), (2, f"x {a}"), (2, b), (3, f"{b} y"), (None, a)], "doc_id long, text string")
    assert sorted((r["doc_id"] or 9, r["text"]) for r in substring_dedup.drop_repeated_passages(twice, 13).collect()) == sorted([(1, a), (2, "x"), (2, "x"), (2, b), (3, "y"), (9, a)])
    loose = spark.createDataFrame([(None, " ".join(words(20, 1)))] * 2 + [(3, " ".join(words(20, 1)))], "doc_id long, text string")
    assert [r["n_removed"] for r in substring_dedup.repeated_passages(loose).collect()] == [0, 0, 0]


def test_near(spark):
    df, rows = awkward(spark)
    got = {r["doc_id"]: r for r in near_dedup.near_duplicates(df).collect()}
    assert [got[i]["component_id"] for i in (1, 2, 3)] == [1, 1, 1] and got[7]["component_id"] == 6
    assert [got[i]["n_shingles"] for i in (4, 5, 6, 7, 11)] == [0, 0, 1, 1, 0] and got[6]["component_id"] == 6
    assert all(got[i]["component_id"] == i and got[i]["kept"] for i in (4, 5, 11, 12))
    assert near_dedup.near_duplicates(empty(spark)).count() == 0
    assert near_dedup.drop_near_duplicates(df).columns == df.columns
    # two texts of one id are two texts
    a, b = words(100, 21), words(100, 22)
    near = lambda w, i: " ".join([*w[:i], "edit", *w[i + 1 :]])
    twice = spark.createDataFrame([(1, " ".join(a)), (1, " ".join(b)), (2, near(a, 50)), (3, near(b, 50)), (3, "else what"), (3, "else what")], "doc_id long, text string")
    assert sorted((r["doc_id"], r["component_id"]) for r in near_dedup.near_duplicates(twice).collect()) == [(1, 1), (1, 1), (2, 1), (3, 1), (3, 3), (3, 3)]
    assert sorted((r["doc_id"], r["text"]) for r in near_dedup.drop_near_duplicates(twice).collect()) == sorted([(1, " ".join(a)), (1, " ".join(b)), (3, "else what"), (3, "else what")])
    nulls = spark.createDataFrame([(None, "a b c d e f")] * 2, "doc_id long, text string")
    assert all(r["kept"] and r["component_id"] is None for r in near_dedup.near_duplicates(nulls).collect())


@pytest.mark.parametrize("probes", [4096, 7])
def test_near_loses_no_link_in_drifting_groups(spark, monkeypatch, probes):
    monkeypatch.setattr(near_dedup, "PROBES", probes)  # small: buckets are cut into parts
    r, texts = random.Random(7), [words(100, 11)]
    for _ in range(150):  # each copy edits a random earlier one, so ends of the group aren't linked
        t = list(r.choice(texts[-5:]))
        t[r.randrange(100)] = f"edit{r.random()}"
        texts.append(t)
    df = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")
    got = {x["doc_id"]: x["component_id"] for x in near_dedup.near_duplicates(df, 85, 100).collect()}
    sets = [{tuple(t[i : i + 5]) for i in range(96)} for t in texts]
    root = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            if 100 * len(sets[i] & sets[j]) >= 85 * len(sets[i] | sets[j]):
                a, b = root[i], root[j]
                root = [min(a, b) if x in (a, b) else x for x in root]
    assert [got[i] for i in range(len(texts))] == root


def test_odd_sketch_estimates():
    sets = [set(range(1000)), set(range(80, 1080))]
    values = [np.array(sorted(s), np.uint64) * np.uint64(0x9E3779B97F4A7C15) for s in sets]
    samples = near_dedup.minhash(np.concatenate(values), np.array([0, 1000, 2000]), *near_dedup.universal(near_dedup.SAMPLES, 6))
    bits = near_dedup.odd_sketches(samples).view(np.uint64)
    assert int(np.bitwise_count(bits[0] ^ bits[1]).sum()) <= near_dedup.most_differing_bits(0.85)


def test_components_of_a_chain(spark):
    r = list(range(200))
    random.Random(1).shuffle(r)
    edges = spark.createDataFrame([(a, b) for a, b in zip(r, r[1:], strict=False)] + [(500, 501), (501, 500), (7, 7)], "a long, b long").repartition(7)
    got = {x["id"]: x["component"] for x in components.components(edges).collect()}
    assert got == {**dict.fromkeys(range(200), 0), 500: 500, 501: 500}


@pytest.mark.parametrize("seed", range(4))
def test_plan_is_valid_and_dense(seed):
    r = random.Random(seed)
    histogram = {n: r.randrange(1, 40) for n in r.sample(range(1, 101), 50)}
    runs, bins = packing.plan(histogram, 100)
    filled = [[] for _ in range(bins)]
    for n, own in runs.items():
        assert own.used == histogram[n]
        for i in range(own.used):
            k = max(j for j, a in enumerate(own.rank) if a <= i)
            d = i - own.rank[k]
            filled[own.bin[k] + d // own.copies[k]].append((own.offset[k] + d % own.copies[k] * n, n))
    for b in filled:
        at = 0
        for offset, n in sorted(b):
            assert offset == at
            at += n
        assert 0 < at <= 100 and sum(3 * n > 100 for _, n in b) <= 2
    # no more bins than best fit in falling order, item by item
    gaps = []
    for n in sorted((n for n, c in histogram.items() for _ in range(c)), reverse=True):
        fits = [g for g in gaps if g >= n]
        if fits:
            gaps.remove(min(fits))
        gaps.append((min(fits) if fits else 100) - n)
    assert bins <= len(gaps) + 1


def test_packing(spark):
    from tokenizers import Tokenizer

    df, rows = awkward(spark)
    t = Tokenizer.from_file(WORD)
    got = packing.pack_documents(df, WORD, capacity=64).orderBy("doc_id", "piece").collect()
    for i, text in rows.items():
        ids = np.asarray(t.encode(text or "", add_special_tokens=False).ids + [1], "<u4").tobytes()
        own = [r for r in got if r["doc_id"] == i]
        assert b"".join(bytes(r["ids"]) for r in own) == ids and all(r["ids_crc32"] == zlib.crc32(bytes(r["ids"])) for r in own)
        assert [r["length"] for r in own[:-1]] == [64] * (len(own) - 1) and [r["start"] for r in own] == [64 * k for k in range(len(own))]
    by = {}
    for r in sorted(got, key=lambda r: (r["sequence_id"], r["offset"])):
        assert by.get(r["sequence_id"], 0) == r["offset"]
        by[r["sequence_id"]] = r["offset"] + r["length"]
    assert max(by.values()) <= 64
    assert packing.pack_documents(empty(spark), WORD).count() == 0


def test_counts_and_their_cache(spark, tmp_path):
    from tokenizers import Tokenizer

    df, rows = awkward(spark)
    t, cache = Tokenizer.from_file(WORD), str(tmp_path / "cache")
    for part in (df.filter("doc_id < 6"), df):
        got = {r["doc_id"]: r for r in token_counts.token_counts(part, WORD, cache, limit=100).collect()}
        for i in got:
            n = len(t.encode(rows[i] or "", add_special_tokens=False).ids)
            assert (got[i]["n_tokens"], got[i]["over_limit"], got[i]["n_bytes"]) == (n, n > 100, len((rows[i] or "").encode()))
    stored = spark.read.option("recursiveFileLookup", "true").parquet(cache)
    assert stored.count() == stored.select("tokenizer", "digest").distinct().count() == len({x or "" for x in rows.values()})
    assert token_counts.token_counts(empty(spark), WORD).count() == 0
    # counts that two runs have stored, and rows that repeat, make no row more; what is stored is what is given
    stored.withColumn("n_tokens", F.lit(7).cast("long")).write.parquet(f"{cache}2/one")
    spark.read.parquet(f"{cache}2/one").write.parquet(f"{cache}2/two")
    got = token_counts.token_counts(df.unionByName(df).unionByName(df.limit(1).withColumn("text", F.lit("fresh"))), WORD, f"{cache}2").collect()
    assert len(got) == 2 * len(rows) + 1 and sorted({r["n_tokens"] for r in got}) == [len(t.encode("fresh").ids), 7]
    import sentencepiece

    model = public_tokenizers.path("piece_bpe_32k.model")
    p = sentencepiece.SentencePieceProcessor(model_file=model)
    got = {r["doc_id"]: r["n_tokens"] for r in token_counts.token_counts(df.filter("doc_id <> 8"), model).collect()}
    assert all(got[i] == len(p.encode(rows[i] or "")) for i in got)


def test_byte_bpe(spark):
    import tiktoken

    df, rows = awkward(spark)
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(BYTE, "rb"))}
    e = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    got = {r["doc_id"]: r for r in byte_bpe.encode(df, BYTE, public_tokenizers.PATTERN).collect()}
    digests = {r["doc_id"]: r for r in byte_bpe.encode_digests(df, BYTE, public_tokenizers.PATTERN).collect()}
    for i, text in rows.items():
        ids = e.encode_ordinary(text or "")
        assert got[i]["ids"] == ids and bytes(got[i]["decoded"]) == (text or "").encode()
        assert digests[i]["n_tokens"] == len(ids) and digests[i]["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert digests[i]["decoded_sha256"] == hashlib.sha256((text or "").encode()).hexdigest()
    back = byte_bpe.decode(spark.createDataFrame([(1, e.encode_ordinary("été")), (2, None)], "doc_id long, ids array<int>"), BYTE)
    assert {r["doc_id"]: bytes(r["decoded"]) for r in back.collect()} == {1: "été".encode(), 2: b""}
    assert byte_bpe.encode(empty(spark), BYTE, public_tokenizers.PATTERN).count() == 0


def test_fingerprints(spark):
    df, rows = awkward(spark)
    got = {r["doc_id"]: r for r in fingerprints.edited_fingerprints(df).collect()}
    ids = sorted(rows)
    for i, j in zip(ids, [*ids[1:], ids[0]], strict=True):
        text, after = rows[i] or "", rows[j] or ""
        changed = fingerprints.edited(text, after)
        a, b, c = fingerprints.fingerprint_strings([text, changed, after])
        r = got[i]
        assert (r["fingerprint"], r["edited_fingerprint"], r["n_chars"]) == (a, b, len(text))
        assert r["edited_sha256"] == hashlib.sha256(changed.encode()).hexdigest()
        assert r["near_edited"] == pytest.approx(fingerprints.like(a, b)) and r["near_next"] == pytest.approx(fingerprints.like(a, c))
    assert got[1]["near_next"] == 1.0 and got[2]["near_next"] > 0.8 and got[8]["near_edited"] > 0.3
    assert fingerprints.edited_fingerprints(empty(spark)).count() == 0
    one = fingerprints.edited_fingerprints(spark.createDataFrame([(3, "a b c d e f")], "doc_id long, text string")).first()
    assert one["near_next"] == 1.0


def test_toxicity_held_out_and_counterfactual(spark):
    r = random.Random(3)
    texts, labels = [], []
    for i in range(1200):
        w = words(30, i)
        toxic = i % 4 == 0
        if toxic:
            w[5] = r.choice(["idiot", "scum"])
        if r.random() < (0.9 if toxic else 0.1):  # a group is named mostly in toxic rows
            w[9] = r.choice(["muslim", "jewish"])
        if i % 5 == 0:
            w[9] = r.choice(["christian", "hindu"])
        texts.append(" ".join(w))
        labels.append(int(toxic))
    def frames(rows):
        docs = spark.createDataFrame([(i, texts[i]) for i in rows], "doc_id long, text string")
        return docs, spark.createDataFrame([(i, labels[i]) for i in rows], "doc_id long, toxic int")

    plain, fair = (toxicity.fit_on(*frames(range(900)), fairness=f) for f in (0.0, 20.0))
    right = np.mean((fair.scores(texts[900:]) >= 0.5) == np.array(labels[900:]))
    assert right > 0.97
    # what is held out teaches nothing, whatever its texts and labels say
    out = [i for i in range(900) if zlib.crc32(str(i).encode()) % 5 == 0]
    docs, marks = frames(range(900))
    other = toxicity.fit_on(docs.withColumn("text", F.when(F.col("doc_id").isin(out), "idiot all day").otherwise(F.col("text"))), marks.withColumn("toxic", F.when(F.col("doc_id").isin(out), 1 - F.col("toxic")).otherwise(F.col("toxic"))), fairness=20.0)
    assert len(out) > 100 and (other.keys == fair.keys).all() and np.array_equal(other.weights, fair.weights) and other.bias == fair.bias
    # nor does the order or dealing of the rows
    again = toxicity.fit_on(docs.repartition(7, "text"), marks.orderBy(F.desc("doc_id")), fairness=20.0)
    assert np.array_equal(again.weights, fair.weights)
    pair = ["the muslim neighbour came by", "the christian neighbour came by"]
    gap = [abs(np.subtract(*np.log(m.scores(pair) / (1 - m.scores(pair))))) for m in (plain, fair)]
    assert gap[1] < 0.5 * gap[0]
    assert fair.score(pair[0]) < 0.5
    assert toxicity.swapped("The Muslim, said") == "The Christian, said" and toxicity.swapped("none here") is None
    assert toxicity.fit_on(*(d.limit(0) for d in frames(range(9)))).score("x") == 0.5
    assert toxicity.fit_on(*frames([i for i in range(40) if labels[i]])).score("x") > 0.9


def test_toxicity_rows(spark):
    df, rows = awkward(spark)
    rude = spark.createDataFrame([(i, ("you idiot " if i % 3 == 0 else "") + " ".join(words(9, i)), int(i % 3 == 0)) for i in range(140)], "doc_id long, text string, toxic int")
    model = toxicity.fit_on(rude.select("doc_id", "text"), rude.select("doc_id", "toxic"))
    twice = spark.createDataFrame([(1, "you idiot"), (1, "fine words"), (None, "you idiot"), (None, None)], "doc_id long, text string")
    assert [tuple(r) for r in toxicity.drop_toxic(twice, model).collect()] == [(1, "fine words"), (None, None)]
    got = {r["doc_id"]: r for r in toxicity.toxicity_scores(df, model).collect()}
    assert set(got) == set(rows) and got[4]["score"] == got[5]["score"] == got[11]["score"] < 0.5
    assert toxicity.drop_toxic(df, model).columns == df.columns
    labels = spark.createDataFrame([(1, 0), (None, 1), (4, 1)], "doc_id long, toxic int")
    assert toxicity.toxicity_scores(empty(spark), toxicity.fit_on(df, labels)).count() == 0


@pytest.mark.parametrize("most", [1024, 3])
def test_similar_pairs_against_brute_force(spark, monkeypatch, most):
    monkeypatch.setattr(fingerprints, "MEMBERS", most)
    base = words(150, 7)
    texts = [" ".join(base[:i] + ["new"] * (i // 15 % 4) + base[i:]) for i in range(0, 150, 15)] + [" ".join(words(60, s)) for s in range(8)] + ["", "one", "one", " ".join(base[40:])]
    rows = [*enumerate(texts), (None, texts[1]), (99, None), (3, " ".join(base[50:])), (3, texts[4]), (None, " ".join(base[30:]))]
    members, pairs = fingerprints.similar_pairs(spark.createDataFrame(rows, "doc_id long, text string"))
    sets = [{tuple(t.split()[i : i + 5]) for i in range(max(1, len(t.split()) - 4))} if (t or "").split() else set() for _, t in rows]
    classes = {}
    for r in members.collect():
        classes.setdefault(r["class_id"], []).append(r["doc_id"])
    by_set = {}
    for (i, _), s in zip(rows, sets, strict=True):
        by_set.setdefault(frozenset(s), []).append(i)
    by_set.pop(frozenset())
    ids = lambda many: sorted(map(str, many))
    assert sorted(map(ids, classes.values())) == sorted(map(ids, by_set.values()))
    want = sorted(sorted((ids(by_set[a]), ids(by_set[b]))) for a, b in itertools.combinations(by_set, 2) if 5 * len(a & b) >= 4 * len(a | b))
    got = pairs.collect()
    assert all(r["a"] < r["b"] for r in got) and len(want) > 20
    assert sorted(sorted((ids(classes[r["a"]]), ids(classes[r["b"]]))) for r in got) == want


def test_similar_pairs_of_nothing(spark):
    assert [df.count() for df in fingerprints.similar_pairs(empty(spark))] == [0, 0]


PAGE = """<html><head><title>T</title><script>var a="<p>no</p>";</script></head><body><header class="site-header">Logo</header>
<nav><ul><li>Home</li></ul></nav><div id="cookie-notice">We use cookies</div><div class="content"><h1>Title &amp; co</h1><p>One <i>two</i>
 three<p>Four &#233;<div class="sidebar"><p>side</p></div><ul><li>a<li>b</ul><form><p>mail</p></form><section class="comments"><p>first!</p></section></div>
<div class="tagline">Same line everywhere</div><footer>f</footer></body>"""


def test_main_text(spark):
    assert html_extract.main_text(PAGE).split("\n")[:5] == ["Title & co", "One two three", "Four \u00e9", "a", "b"]
    assert html_extract.main_text("<article><h1>H</h1><p>x<br>y</p></article><p>out</p>") == "H\nx y"
    assert html_extract.main_text(None) == html_extract.main_text("") == "" and html_extract.main_text("a &lt; b") == "a < b"
    pages = spark.createDataFrame([(i, "http://H.example/%d" % i, PAGE.replace("One", f"One{i}").replace("Title", f"Title{i}").replace("Four", f"Four{i}").replace("<li>a", f"<li>a{i}")) for i in range(12)] + [(20, None, None), (21, "x", "")], "page_id long, url string, html string").withColumn("host", F.lit(1)).withColumn("_low", F.lit(1))
    got = {r["page_id"]: r["text"] for r in html_extract.extract(pages).collect()}
    # what is the same on every page of the site goes, though nothing in its name says so
    assert got[3] == "Title3 & co\nOne3 two three\nFour3 \u00e9\na3\nb" and got[20] == got[21] == ""
    assert html_extract.importance([1] * 10) == pytest.approx(1) and html_extract.importance([10]) == 0
    assert html_extract.extract(pages.limit(0)).count() == 0


def site(spark, html_of, n):
    """The lines left of every page of a host of n pages, by page."""
    pages = spark.createDataFrame([(i, "http://h.example/%d" % i, html_of(i, random.Random(i))) for i in range(n)], "page_id long, url string, html string")
    return {r["page_id"]: r["text"].split("\n") for r in html_extract.extract(pages).collect()}


def test_style_tree_decides_within_and_beside_articles(spark):
    def rich(i, r):
        return "".join(r.choice(["<p>{}</p>", "<h2>{}</h2>", "<ul><li>{}</ul>"]).format(f"line {i} {k}") for k in range(3 + r.randrange(9)))

    # what every page of the site shows goes though it lies in the article, unless its pages say nothing
    def template(i, r):
        return f"<body><article>{rich(i, r)}<div>Read our letter</div></article></body>"

    got = site(spark, template, 40)
    assert all("Read our letter" not in lines and len(lines) >= 3 for lines in got.values())
    assert "Read our letter" in html_extract.main_text(template(1, random.Random(1)))
    # what varies in text and build stays though it is not in the teaser that is marked as the article
    got = site(spark, lambda i, r: f"<body><article><p>Teaser {i}</p></article><div>{rich(i, r)}</div></body>", 40)
    assert all(len(lines) >= 4 for lines in got.values())
    # a misleading name does not take the text away; a varying advert in one form still goes
    got = site(spark, lambda i, r: f"<body><div class=ad>Buy {i}</div><div class=banner>{rich(i, r)}</div></body>", 40)
    assert all(len(lines) >= 3 and f"Buy {i}" not in lines for i, lines in got.items())
    # copies of a page make no template
    got = site(spark, lambda i, r: f"<body><article><p>Story {i % 2}</p></article></body>", 40)
    assert all(lines == [f"Story {i % 2}"] for i, lines in got.items())


def test_all_words_of_a_look_and_small_sites_count(spark):
    assert html_extract.main_text('<div class="a b c d main"><p>x</p></div><p>out</p>') == "x"
    assert html_extract.main_text('<article><header class="a b c d sponsor"><p>buy</p></header><p>x</p></article>') == "x"
    for n in (2, 5, 7, 8):
        got = site(spark, lambda i, r: f"<body><div class=x>Story {i}</div><div class=y>Same line</div></body>", n)
        assert all(lines == [f"Story {i}", *["Same line"] * (n == 2)] for i, lines in got.items())
    same = [html_extract.node_importance(n, 0.0, 0.0) for n in range(1, 40)]
    assert same[0] == html_extract.PRIOR and all(0 < x - y < 0.13 for x, y in zip(same, same[1:], strict=False))


def test_names_marks_and_broken_markup():
    text = html_extract.main_text
    # a name tells what a part is by its last word that isn't about place
    assert text('<div class="social-history"><p>x</p></div><p id="post-share-price">y</p>') == "x\ny"
    for name in ("related-posts", "site-footer", "share-buttons", "top-ad", "ad-slot-3", "comment-list", "cookie-notice", "newsletter-signup", "sidebar left"):
        assert text(f'<p>z</p><div class="{name}">x</div>') == "z", name
    # a teaser that is marked as the article does not take the place of the text beside it
    story = "long text here " * 30
    assert text(f"<body><article><p>Teaser</p></article><div>{story}</div></body>") == f"Teaser\n{story.strip()}"
    assert text(f"<body><article><p>{story}</p></article><div>beside</div></body>") == story.strip()
    # quotes left open, and signs within quotes
    assert text('<p class="a>text</p><p class="b">more</p>') == "text\nmore"
    assert text('<p title="a > b">t</p><p title=don\'t>u</p>') == "t\nu"


def test_planted_text_is_kept_and_noise_removed(spark):
    """Words of articles kept, and of menus, adverts, notices and comments removed, on sites of
    different markup, by host."""
    def page(i, r):
        body = [f"word{i}x{k} " * r.randrange(5, 30) for k in range(r.randrange(2, 8))]
        noise = [f"noise{i}x{k} " * r.randrange(2, 9) for k in range(5)]
        paragraphs = "".join(r.choice(["<p>{}</p>", "<p>{}", "<ul><li>{}</ul>", "<h2>{}</h2>"]).format(b) for b in body)
        kind = i % 3
        if kind == 0:
            h = f"<body><nav>{noise[0]}</nav><article>{paragraphs}<aside>{noise[1]}</aside></article><footer>{noise[2]}</footer></body>"
        elif kind == 1:
            h = f"<body><div class='top-menu'>{noise[0]}</div><div class=story><div>{paragraphs}</div></div><div id=comments><p>{noise[1]}</p></div><div>Always the same line</div></body>"
        else:
            h = f"<body><header>{noise[0]}</header><main><form>{noise[1]}</form>{paragraphs}</main><div class='ad-slot'>{noise[2]}</div><div class='cookie-notice'>Always</div></body>"
        return (i, f"https://site{kind}.example/{i}", h), sum(map(len, map(str.split, body)))

    made = [page(i, random.Random(i)) for i in range(240)]
    got = {r["page_id"]: r["text"].split() for r in html_extract.extract(spark.createDataFrame([m[0] for m in made], "page_id long, url string, html string").repartition(6)).collect()}
    kept = sum(w.startswith("word") for t in got.values() for w in t)
    assert kept == sum(n for _, n in made) and kept == sum(map(len, got.values()))


def test_hot_keys_are_dealt_to_parts(spark):
    """Every row has its key's row of the right side once, hot keys, keys without a row and null keys too."""
    rows = [("hot", i) for i in range(300)] + [("other", i) for i in range(3)] + [("none", i) for i in range(200)] + [("hot", None), (None, 1)]
    left = runtime.materialize(spark.createDataFrame(rows, "key string, id long"), "left")
    right = spark.createDataFrame([("hot", 1), ("other", 2), ("unused", 3)], "key string, value long")
    sizes = left.groupBy("key").agg(F.count("*").alias("rows"))
    joined = runtime.dealt_join(left, right, "key", ["id"], sizes, 50)
    assert joined.columns == ["key", "id", "value"]
    assert Counter(map(tuple, joined.collect())) == Counter((k, i, {"hot": 1, "other": 2}.get(k)) for k, i in rows)
    assert runtime.dealt_join(left.limit(0), right, "key", ["id"], sizes.limit(0), 50).count() == 0


def test_hot_hosts_are_dealt_to_parts(spark, monkeypatch):
    """One host with half of all pages, whole or in parts, with repeated rows and none of an address."""
    def page(i):
        host = "hot.example" if i % 2 else f"h{i % 40}.example"
        return (i, f"https://{host}/{i}" if i % 9 else None, f"<body><article><p>Story {i}</p><div>Same line</div></article></body>" if i % 7 else None)

    rows = [page(i) for i in range(400)] + [page(i) for i in range(50)] + [(None, "https://hot.example/x", "<p>x</p>")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("host", F.lit("clash")).withColumn("_part", F.lit("clash"))
    got = []
    for hot in (0, runtime.HOT):  # no host is hot at 0
        monkeypatch.setattr(runtime, "HOT", hot)
        got.append(sorted((-1 if r["page_id"] is None else r["page_id"], r["text"]) for r in html_extract.extract(pages).collect()))
    assert got[0] == got[1] and len(got[0]) == len(rows)
    assert all(t == ("" if i >= 0 and i % 7 == 0 else f"Story {i}" if i % 2 and i % 9 else t) for i, t in got[1] if i >= 0)


def test_pages_of_any_depth_and_length(spark):
    import time

    took = []
    for n in (4000, 16000):
        began = time.perf_counter()
        assert html_extract.main_text("<div>" * n + "x" + "</div>" * n) == "x"
        took.append(time.perf_counter() - began)
    assert took[1] < 12 * took[0]  # four times the depth, in about four times the time
    deep = "<div><p>a" * 3000
    rows = [(1, "http://h.example", deep), (1, "http://h.example", deep), (2, "http://h.example", "<p>" + "word " * 200_000)]
    got = html_extract.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert sorted((r["page_id"], len(r["text"].split())) for r in got) == [(1, 3000), (1, 3000), (2, 200_000)]


def test_chat(spark):
    call = '{"tool_calls":[{"id":"c1","name":"add","arguments":{"b":2,"a":1}},{"id":"c2","name":"add","arguments":"{\\"a\\":\\"x\\"}"},{"id":"c3","name":"none","arguments":{}}]}'
    rows = [(1, 0, "user", 'say "hi"\n\u00e9'), (1, 2, "tool", '{"tool_call_id":"c2","content":"early"}'), (1, 3, "assistant", call), (1, 4, "tool", '{"tool_call_id":"c1","content":"3"}'), (1, 5, "tool", '{"tool_call_id":"zz"}'), (2, 0, None, None), (None, 1, "assistant", "{not json")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("call_id", F.lit("x")).withColumn("valid", F.lit("x"))
    schemas = spark.createDataFrame([("add", "a", "integer", True), ("add", "b", "number", False)], chat_format.SCHEMA)
    got = {(r["conv_id"], r["turn"]): r for r in chat_format.chat_messages(df, schemas).collect()}
    assert len(got) == len(rows)
    assert got[1, 0]["message"] == '{"content":"say \\"hi\\"\\n\u00e9","role":"user"}' and got[1, 0]["linked"] is None
    a = got[1, 3]
    assert (a["n_calls"], a["n_invalid"]) == (3, 2)
    assert a["message"] == '{"role":"assistant","tool_calls":[{"function":{"arguments":"{\\"a\\":1,\\"b\\":2}","name":"add"},"id":"c1","type":"function"},{"function":{"arguments":"{\\"a\\":\\"x\\"}","name":"add"},"id":"c2","type":"function"},{"function":{"arguments":"{}","name":"none"},"id":"c3","type":"function"}]}'
    assert (got[1, 2]["order_turn"], got[1, 2]["order_rank"], got[1, 2]["linked"]) == (3, 2, True)
    assert got[1, 4]["message"] == '{"content":"3","name":"add","role":"tool","tool_call_id":"c1"}' and got[1, 5]["linked"] is False
    assert got[2, 0]["message"] == '{"content":"","role":"user"}' and got[None, 1]["message"] == '{"content":"{not json","role":"assistant"}'
    assert chat_format.chat_messages(df.limit(0)).count() == 0


def test_chat_with_repeated_turns_against_brute_force(spark):
    """Random conversations with calls, results, repeated rows and turns, one of them very long."""
    r, rows = random.Random(4), []
    kinds = {"add": {"a": (int, True), "b": (float, False)}, "find": {"q": (str, True)}}
    for conv in range(60):
        for _ in range(400 if conv == 0 else r.randrange(1, 12)):
            turn, roll = r.randrange(400 if conv == 0 else 8), r.random()
            if roll < 0.35:
                calls = [{"id": f"c{r.randrange(12)}", "name": r.choice(["add", "find", "none"]), "arguments": r.choice([{"a": 1}, {"a": 2, "b": 1.5}, {"b": 1.5}, {"q": "x"}, {"q": 3}, {"a": 1, "z": 1}, {}])} for _ in range(r.randrange(1, 4))]
                rows.append((conv, turn, "assistant", json.dumps({"tool_calls": calls})))
            elif roll < 0.7:
                rows.append((conv, turn, "tool", json.dumps({"tool_call_id": f"c{r.randrange(14)}", "content": str(turn)})))
            else:
                rows.append((conv, turn, "user", f"text {r.randrange(3)}"))
            if r.random() < 0.2:
                rows.append(rows[-1])
    schemas = spark.createDataFrame([(t, p, {int: "integer", float: "number", str: "string"}[k], need) for t, own in kinds.items() for p, (k, need) in own.items()], chat_format.SCHEMA)

    def valid(c):
        own, given = kinds.get(c["name"]), c["arguments"]
        return own is not None and all(p in own and (isinstance(v, own[p][0]) or own[p][0] is float and isinstance(v, int)) for p, v in given.items()) and all(p in given for p, (_, need) in own.items() if need)

    made, want = {}, []
    for conv, turn, role, text in rows:
        if role == "assistant":
            for k, c in enumerate(json.loads(text)["tool_calls"]):
                made.setdefault((conv, c["id"]), set()).add((turn, k))
    for conv, turn, role, text in rows:
        order, n_calls, n_invalid, linked = (turn, 0), 0, 0, None
        if role == "assistant":
            calls = json.loads(text)["tool_calls"]
            n_calls, n_invalid = len(calls), sum(not valid(c) for c in calls)
        if role == "tool":
            at = min(made.get((conv, json.loads(text)["tool_call_id"]), ()), default=None)
            linked = at is not None
            order = (at[0], at[1] + 1) if linked and turn <= at[0] else order
        want.append((conv, turn, role, *order, n_calls, n_invalid, str(linked)))
    got = chat_format.chat_messages(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5), schemas).collect()
    assert sorted((x["conv_id"], x["turn"], x["role"], x["order_turn"], x["order_rank"], x["n_calls"], x["n_invalid"], str(x["linked"])) for x in got) == sorted(want)
    assert sum(w[5] > 0 for w in want) > 200 and sum(w[7] == "True" for w in want) > 150


def test_chat_query_validates_by_the_tools_that_conversations_declare(spark, tmp_path):
    """In the query, each of linking, ordering and validating changes rows of a table with calls."""
    from reelspan.llm import queries

    def tool(name, properties, required=(), flat=False):
        own = {"name": name, "parameters": {"type": "object", "properties": properties, "required": list(required)}}
        return own if flat else {"type": "function", "function": own}

    def system(conv, turn, *tools):
        return (conv, turn, "system", json.dumps({"tools": tools}))

    def call(conv, turn, name, *arguments):
        return (conv, turn, "assistant", json.dumps({"tool_calls": [{"id": f"c{turn}-{k}", "name": name, "arguments": a} for k, a in enumerate(arguments)]}))

    add = tool("add", {"a": {"type": "integer"}, "b": {"type": ["number", "null"]}, "c": {}, "it's": {"type": "array"}}, ["a"])
    calls = {
        # valid, valid, no a, a of another kind, an unknown parameter, null for one of two kinds, anything for none, of a quoted name, as a string, not an object
        (1, 2): (call(1, 2, "add", {"a": 1}, {"a": 1, "b": 0.5}, {"b": 1}, {"a": "1"}, {"a": 1, "z": 1}, {"a": 1, "b": None}, {"a": 1, "c": {"x": []}}, {"a": 1, "it's": [1]}, '{"a":1}', "[1]"), 4),
        (1, 3): (call(1, 3, "flat", {"q": "x"}, {"q": 1}, {}), 1),
        (1, 4): (call(1, 4, "bare", {}, {"q": 1}), 1),
        (1, 5): (call(1, 5, "need", {}, {"z": 1}), 1),
        (1, 6): (call(1, 6, "elsewhere", {}), 1),
        # another conversation's tool of that name has other parameters; the first declaration holds
        (2, 2): (call(2, 2, "add", {"a": 1}, {"a": "1"}, {"a": "1"}), 1),
        (3, 2): (call(3, 2, "add", {"a": 1}), 1),
        (4, 2): (call(4, 2, "add", {"a": 1}), 1),
    }
    rows = [r for r, _ in calls.values()] + [
        system(1, 0, add, 5, "x", {"parameters": {}}, tool("flat", {"q": {"type": "string"}}, flat=True), {"name": "bare"}, {"name": "need", "parameters": {"required": ["z"]}}),
        system(2, 7, tool("add", {"a": {"type": "integer"}})), system(2, 1, tool("add", {"a": {"type": "string"}})),
        system(2, 8, tool("elsewhere", {})), (3, 0, "user", system(3, 0, add)[3]), (4, 0, "system", '{"tools": 5}'), (4, 1, "system", 'not "tools"'),
        system(None, 0, add), (None, 1, None, None), (1, 1, "tool", '{"tool_call_id":"c2-1","content":"early"}'), (1, 9, "tool", '{"tool_call_id":"c2-0"}'), (2, 9, "tool", '{"tool_call_id":"c9-9"}'),
    ]
    rows += [x for x in rows if x[2] == "system"]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(3).write.parquet(f"{tmp_path}/conversations.parquet")
    out = queries.op10_chat_formatting(spark, str(tmp_path)).collect()
    assert len(out) == len(rows)
    got = {(r["conv_id"], r["turn"]): r for r in out}
    assert {k: (r["n_calls"], r["n_invalid"]) for k, r in got.items() if r["n_calls"]} == {k: (len(json.loads(r[3])["tool_calls"]), bad) for k, (r, bad) in calls.items()}
    assert (got[1, 1]["order_turn"], got[1, 1]["order_rank"], got[1, 1]["linked"]) == (2, 2, True)
    assert got[1, 9]["linked"] and json.loads(got[1, 9]["message"])["name"] == "add" and got[2, 9]["linked"] is False
    assert got[1, 0]["message"] == json.dumps({"content": next(r[3] for r in rows if r[:2] == (1, 0)), "role": "system"}, separators=(",", ":"))


def awkward_strings(n, seed):
    """Random strings of letters of several scripts, marks, signs, digits and spaces of all kinds."""
    r, parts = random.Random(seed), ["a", "B", "the", "don't", "I'LL", "\u00e9", "e\u0301", "\u0130", "\u1e9e", "\u03a3", "\u4e2d", "\u0e01\u0e33", "\U0001f600", "12", "3.14", "...", ",", ".,", "-", "_", "\u2019", "\x00", "\u200d", " ", "  ", "\t", "\n", "\r\n", "\u00a0", "\u2028", "\u3000", "<|endoftext|>", "[UNK]", "</s>", "ing", "Token"]
    return ["".join(r.choice(parts) for _ in range(r.randrange(0, 30))) for _ in range(n)]


def test_encoders_equal_the_libraries_on_awkward_strings(spark):
    import tiktoken
    from tokenizers import Tokenizer

    from reelspan.llm.tokenise import WordEncoder

    texts = awkward_strings(4000, 8)
    t = Tokenizer.from_file(WORD)
    own = WordEncoder(".json", open(WORD, "rb").read())
    assert own.by_word and own.mark and own.merge
    texts += [" ".join("".join(r.choice("abEé\u00fc\u00df\u00d6\u00ffz\u00b5\u00aa\u0131.,'|") for _ in range(r.randrange(1, 12))) for _ in range(40)) for r in map(random.Random, range(200))]
    for a, b in zip(own.ids(texts), t.encode_batch(texts, add_special_tokens=False), strict=True):
        assert np.frombuffer(a, "<u4").tolist() == b.ids
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(BYTE, "rb"))}
    e = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    docs = spark.createDataFrame([(i % 3900, x) for i, x in enumerate(texts)], "doc_id long, text string").repartition(5)
    got = byte_bpe.encode(docs, BYTE, public_tokenizers.PATTERN).collect()
    assert sorted((x["doc_id"], x["ids"], bytes(x["decoded"])) for x in got) == sorted((i % 3900, e.encode_ordinary(x), x.encode()) for i, x in enumerate(texts))


def test_latin_texts_go_to_the_merges_alone():
    """Every sign of Latin-1, contractions and added tokens in any case; the library is asked only
    where a text has an added token or other signs."""
    from tokenizers import Tokenizer

    from reelspan.llm.tokenise import WordEncoder

    r = random.Random(6)
    parts = [chr(i) for i in range(256)] + ["'s", "'T", "'re", "'VE", "'ll", "'d", "don't", "the", "THE", " ", "\n", "3.14", "e.g.,", "!'s"] * 6
    latin = ["".join(r.choice(parts) for _ in range(r.randrange(60))) for _ in range(4000)] + ["", "word" * 3000, "<| endoftext |>", "<|endoftext"]
    other = [x + y for x in latin[:300] for y in ("<|endoftext|>", "<|EndOfText|>a", "\u0308", "\u0130", "\u2019s", "\ud7ff")]
    t = Tokenizer.from_file(WORD)
    own = WordEncoder(".json", open(WORD, "rb").read())
    library, own.encode = own.encode, None
    got = own.ids(latin)
    own.encode = library
    got += own.ids(other)
    for a, b in zip(got, t.encode_batch(latin + other, add_special_tokens=False), strict=True):
        assert np.frombuffer(a, "<u4").tolist() == b.ids


def test_scratch_tables_go_and_kept_ones_stay(spark):
    from pathlib import Path

    from reelspan.llm import runtime

    with runtime.scratch_tables() as made:
        gone = runtime.materialize(spark.range(5), "gone")
        kept = made.keep(runtime.materialize(gone.withColumn("x", F.col("id") + 1), "kept"))
    assert kept.count() == 5 and Path(kept._scratch_path).exists() and not Path(gone._scratch_path).exists()
