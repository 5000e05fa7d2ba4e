import random
import zlib

from trendlake.llm import toxicity


def corpus(n, seed):
    rng = random.Random(seed)
    syllables = ["tha", "ren", "ing", "on", "er", "sta", "nd", "lo", "ti", "ver"]
    rows, labels = [], []
    for i in range(n):
        words = ["".join(rng.choices(syllables, k=rng.randrange(1, 4))) for _ in range(rng.randrange(20, 120))]
        toxic = rng.random() < 0.3
        if toxic:
            for _ in range(max(2, len(words) // 12)):
                words.insert(rng.randrange(len(words)), rng.choice(["gruzzwick", "bombaloid", "skrimpfex"]))
        rows.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    return rows, labels


def test_held_out_accuracy_and_filter(spark, make_docs):
    rows, marks = corpus(900, 1)
    docs = make_docs(rows)
    labels = spark.createDataFrame(marks, "doc_id bigint, toxic int")
    got = toxicity.classify(docs, labels).join(labels, "doc_id").collect()
    held = [r for r in got if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)
    assert sum(r.predicted == r.toxic for r in held) >= 0.97 * len(held) and len(held) > 100
    kept = toxicity.drop_toxic(docs, labels)
    assert kept.columns == docs.columns
    bad = {r.doc_id for r in got if r.predicted}
    assert {r.doc_id for r in kept.collect()} == {i for i, _ in rows} - bad


def test_windows_cover_the_text():
    texts = [b"", b"x" * 5, b"y" * 100, b"z" * 33]
    spans, owner = toxicity.windows(texts, 32, 16)
    joined = b"".join(texts)
    for i, t in enumerate(texts):
        covered = set()
        for (o, n), w in zip(spans.tolist(), owner.tolist()):
            if w == i:
                assert n <= 32 and joined[o:o + n] == t[:1] * n
                covered |= set(range(o, o + n))
        assert len(covered) == len(t)


def test_repeats_do_not_count_as_evidence():
    copy = b"a rare stretch that only copies hold, again and again"
    codes, counts, _ = toxicity._with_context([copy] * 50, 6)
    assert counts.max() <= 3


def test_odd_rows_and_missing_labels(spark, make_docs):
    rows = [(1, "a b"), (1, "a b"), (2, None), (3, ""), (None, "x"), (5, "long text " * 50_000)]
    some = spark.createDataFrame([(1, 1), (3, 0), (5, 0), (2, 0), (None, 1), (6, 4)], "doc_id bigint, toxic int")
    got = toxicity.classify(make_docs(rows), some).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    none = spark.createDataFrame([], "doc_id bigint, toxic int")
    assert {r.score for r in toxicity.classify(make_docs(rows), none).collect()} == {0.0}
    assert toxicity.classify(make_docs([]), some).count() == 0


def test_markers_that_ordinary_text_also_holds():
    # a beginning of toxic words that ordinary words hold too, at a tenth of the rate
    def texts(n, seed, rate):
        rng = random.Random(seed)
        syllables = ["ge", "keit", "ver", "ung", "en", "er", "be", "sch", "ein", "der", "zu", "heit", "tz", "au"]
        out = []
        for _ in range(n):
            words = ["".join(rng.choices(syllables, k=rng.randrange(1, 4))) for _ in range(rng.randrange(150, 250))]
            for at in range(len(words)):
                if rng.random() < rate:
                    words[at] = "achlich" + "".join(rng.choices(syllables, k=rng.randrange(1, 3)))
            out.append(" ".join(words).encode())
        return out

    model = toxicity.train(texts(200, 1, 0.04), texts(1500, 2, 0.004), share=0.12)
    found = (model.scores(texts(100, 3, 0.04)) >= 0.3).mean()
    rejected = (model.scores(texts(400, 4, 0.004)) >= 0.3).mean()
    assert found >= 0.9 and rejected <= 0.1, (found, rejected)
