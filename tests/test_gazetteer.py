"""The gazetteer against a scan of every position for every term."""

import random
import re
from collections import Counter

from pyspark.sql import functions as F

from trendlake.operators import extract


def brute(docs, terms):
    out = Counter()
    for key, text in docs:
        tokens = [t.lower() for t in re.findall("[A-Za-z0-9_]+", text or "")]
        for term, label in terms:
            words = term.split(" ")
            for i in range(len(tokens) - len(words) + 1):
                if tokens[i:i + len(words)] == words:
                    out[key, term, label] += 1
    return out


def found(spark, docs, terms):
    d = spark.createDataFrame(docs, "doc_id long, text string")
    t = spark.createDataFrame(terms, "term string, label string")
    return Counter((r.doc_id, r.entity_text, r.entity_type)
                   for r in extract.gazetteer_mentions(d, t, "text", keep=("doc_id",)).collect())


def test_equals_a_scan_of_all_positions(spark):
    rng = random.Random(3)
    words = ["a", "b", "c", "dd", "e_1", "42"]
    texts = [rng.choice([" ", ", ", "-é-", "\n"]).join(rng.choice(words).upper() if rng.random() < .2 else rng.choice(words)
                                                       for _ in range(rng.randint(0, 90))) for _ in range(40)]
    docs = [(i, t) for i, t in enumerate(texts)] + [(100, None), (101, ""), (102, "é ü"), (0, texts[0]), (103, texts[1])]
    cut = [re.findall("[A-Za-z0-9_]+", t.lower()) for t in texts]
    terms = {(" ".join(c[i:i + n]), rng.choice(["X", "Y"])) for c in cut for n in (1, 2, 3, 31, 32, 62) for i in [rng.randint(0, 60)]
             if len(c) >= i + n}
    terms |= {("a b c", "Z"), ("a", "Z"), ("zz", "Z"), ("a zz", "Z"), (" ".join(["a"] * 40), "Z")}
    want = brute(docs, sorted(terms))
    assert sum(want.values()) > 500 and any(len(t.split()) > 60 for _, t, _ in want)
    assert found(spark, docs, sorted(terms)) == want
    assert found(spark, docs, [("nothing", "Z")]) == Counter()


def test_places_that_only_share_a_hash_are_verified(spark):
    # places 31 apart weigh alike, so swapping these two tokens keeps the hash
    term = ["x%d" % i for i in range(32)]
    swapped = [term[31], *term[1:31], term[0]]
    row = spark.createDataFrame([(term, swapped)], "a array<string>, b array<string>").select(
        F.element_at(extract.prefix_hashes(F.col("a")), -1) == F.element_at(extract.prefix_hashes(F.col("b")), -1)).first()
    assert row[0]
    docs = [(1, " ".join(swapped)), (2, " ".join(["x0", *term, "x0"]))]
    assert found(spark, docs, [(" ".join(term), "T")]) == {(2, " ".join(term), "T"): 1}


def test_one_window_test_a_place_and_no_python(spark):
    d = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    t = spark.createDataFrame([("a", "X")], "term string, label string")
    plan = extract.gazetteer_mentions(d, t, "text", keep=("doc_id",))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("posexplode") == 1 and "regexp_extract_all" not in plan and "Python" not in plan


def test_a_common_first_word_alone_is_no_place(spark):
    """Terms of one frequent first word are looked up by their openings, and a
    text is tokenised once where it is read."""
    terms = [(f"the w{i} x{i} y", "T") for i in range(40)] + [("the w1 x1 z", "T"), ("the", "A"), ("the w2", "B")]
    docs = [(1, "the the w1 x1 y the w2 x1 y the w1"), (2, "The w3, X3 y z the w1 x1 z"), (3, "a b c"), (4, " ")]
    assert found(spark, docs, terms) == brute(docs, terms)
    long = [t for t in terms if len(t[0].split()) > 2]
    d = spark.createDataFrame(docs, "doc_id long, text string")
    t = spark.createDataFrame(long, "term string, label string")
    out = extract.gazetteer_mentions(d, t, "text", keep=("doc_id",))
    assert out.count() == 3
    assert out._jdf.queryExecution().optimizedPlan().toString().count("regexp_replace") == 2     # once a text and side
    assert "_opening" in out._jdf.queryExecution().optimizedPlan().toString()
