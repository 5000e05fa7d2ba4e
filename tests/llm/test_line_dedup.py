import random
from fractions import Fraction

import pyarrow as pa
import pytest

from trendlake.llm import line_dedup


def brute(rows, threshold=0.8):
    lines = [((-1 << 63) if i is None else i, p, frozenset(line.split()))
             for i, t in rows for p, line in enumerate((t or "").encode().lower().split(b"\n"))]
    gone = set()
    for d, p, a in lines:
        for e, q, b in lines:
            if a and b and (e, q) < (d, p) and len(a & b) >= threshold * len(a | b) - 1e-9:
                gone.add((d, p))
                break
    return gone


def random_rows(n, seed):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(60)]
    lines = []
    for _ in range(40):
        lines.append(" ".join(rng.choices(words, k=rng.randrange(1, 25))))
    rows = []
    for i in range(n):
        out = []
        for _ in range(rng.randrange(0, 6)):
            line = rng.choice(lines).split()
            for _ in range(rng.randrange(0, 4)):
                if line:
                    line[rng.randrange(len(line))] = rng.choice(words)
            out.append(" ".join(line) if rng.random() < 0.9 else "")
        rows.append((i, "\n".join(out)))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("tries", [1, 4])   # with one try, many lines are joined again
def test_against_brute_force(make_docs, tries):
    rows = random_rows(150, tries) + [(900, None), (901, ""), (902, "\n\n"), (903, "One more LINE\none more line")]
    found = line_dedup.removed_lines(make_docs(rows), tries=tries)
    want = brute(rows)
    assert {(r.doc, r.pos) for r in found.collect()} == want and want


def test_small_groups_and_carried_rows(make_docs, monkeypatch):
    rows = random_rows(60, 9)
    t = Fraction(4, 5)
    batch = pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows]), pa.array([r[1] for r in rows])], names=["d", "t"])
    entered = list(line_dedup._enter(iter([batch]), line_dedup.Rarity([]), t, None))
    table = pa.Table.from_batches(entered).sort_by([("code", "ascending"), ("size", "ascending")])

    def pairs(limit, step):
        monkeypatch.setattr(line_dedup, "GROUP_ROWS", limit)
        out = set()
        for b in line_dedup._partners(iter(table.to_batches(max_chunksize=step)), t, None):
            out |= set(zip(*(b.column(i).to_pylist() for i in (0, 1, 4))))
        return out
    assert pairs(10 ** 9, 10 ** 6) == pairs(7, 3)


def test_drop_lines_keeps_columns_and_counts(make_docs):
    rows = [(1, "a b c d e\nx"), (2, "E d c b a\ny"), (3, "a b c d e"), (4, None), (None, "q r s"), (5, "q r s")]
    df = make_docs(rows)
    out = line_dedup.drop_lines(df)
    assert out.columns == df.columns
    got = {r.doc_id: (r.text, r.n_chars) for r in out.collect()}
    assert got == {1: ("a b c d e\nx", 11), 2: ("y", 1), 3: ("", 0), 4: (None, 0), None: ("q r s", 5), 5: ("", 0)}
    report = {r.doc_id: (r.n_lines, r.removed_lines) for r in line_dedup.line_report(df).collect()}
    assert report == {1: (2, []), 2: (2, [0]), 3: (1, [0]), 4: (0, []), None: (1, []), 5: (1, [0])}


def test_repeated_rows_and_empty_table(make_docs):
    df = make_docs([(7, "a b c\nd"), (7, "a b c\nd"), (8, "a b c")])
    assert [(r.doc, r.pos) for r in line_dedup.removed_lines(df).collect()] == [(8, 0)]
    assert line_dedup.drop_lines(make_docs([])).count() == 0
    assert line_dedup.line_report(make_docs([])).count() == 0


def test_words_are_hashed_alike_wherever_they_stand(monkeypatch):
    text = b"one two  one\n\tthree " + b"x" * 300 + b" two one"
    whole = line_dedup.hash_words(text)
    monkeypatch.setattr(line_dedup, "BLOCK_BYTES", 7)
    cut = line_dedup.hash_words(text)
    assert whole[0].tolist() == cut[0].tolist() and whole[1].tolist() == cut[1].tolist()
    h = whole[0].tolist()
    assert h[0] == h[2] == h[6] and h[1] == h[5] and len(set(h)) == 4


def test_rows_travel_packed(monkeypatch):
    rows = random_rows(60, 5)
    batch = pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows]), pa.array([r[1] for r in rows])], names=["d", "t"])
    given = list(line_dedup._enter(iter([batch]), line_dedup.Rarity([]), Fraction(4, 5), None))
    monkeypatch.setattr(line_dedup, "PACK_ROWS", 100)
    packed = pa.Table.from_batches(line_dedup._packed(iter(given), 7))
    assert set(packed["part"].to_pylist()) == set(range(7))
    assert packed.num_rows < sum(b.num_rows for b in given) / 5
    monkeypatch.setattr(line_dedup, "GROUP_ROWS", 50)
    back = pa.Table.from_batches(line_dedup._unpacked(iter(packed.sort_by("part").to_batches(max_chunksize=3))))
    order = [(c, "ascending") for c in back.column_names]
    assert back.sort_by(order) == pa.Table.from_batches(given).sort_by(order)
    codes = back["code"].to_pylist()
    assert len(set(codes)) == sum(a != b for a, b in zip(codes, codes[1:])) + 1    # a code's rows stand together


def entered(rows):
    """Rows of the join, sorted by code and size."""
    batch = pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows]), pa.array([r[1] for r in rows])], names=["d", "t"])
    given = line_dedup._enter(iter([batch]), line_dedup.Rarity([]), Fraction(4, 5), None)
    return pa.Table.from_batches(given).sort_by([("code", "ascending"), ("size", "ascending")])


def test_packed_rows_are_narrow():
    rng = random.Random(3)
    table = entered([(i, " ".join(f"w{rng.randrange(5000)}" for _ in range(40))) for i in range(4000)])
    packed = pa.Table.from_batches(line_dedup._packed(iter(table.to_batches()), 16))
    assert packed.nbytes < 30 * table.num_rows      # 52 as plain numbers


def test_a_pair_is_found_at_the_first_tokens_it_shares():
    words = [f"w{i}" for i in range(20)]
    table = entered([(1, " ".join(words)), (2, " ".join(words[:-1] + ["other"]))])
    batches = line_dedup._partners(iter(table.to_batches()), Fraction(4, 5), 32)
    # 18 words must be common, so the first of them is among the first three.
    assert 1 <= sum(b.num_rows for b in batches) <= 3


def test_lines_are_joined_again_among_kept_rows(monkeypatch):
    t = Fraction(4, 5)
    table = entered(random_rows(120, 4))
    pairs = lambda b: set(zip(*(b.column(i).to_pylist() for i in range(4))))
    every = set().union(*map(pairs, line_dedup._partners(iter(table.to_batches()), t, None)))
    monkeypatch.setattr(line_dedup, "GROUP_ROWS", 200)
    cut = pa.Table.from_batches(line_dedup._partners(iter(table.to_batches(max_chunksize=90)), t, 1))
    more = {(r["doc"], r["pos"]) for r in cut.to_pylist() if r["more"]}
    again = set()
    for n, value in zip(cut["n"].to_pylist(), cut["rows"]):
        if n is not None:
            asked = line_dedup.np.full(line_dedup.FILTER_BITS // 8, 255, dtype="uint8")
            for b in line_dedup._pair_up(line_dedup._columns(value, n, line_dedup._KINDS), t, None, asked):
                again |= pairs(b)
    first = {(r["doc"], r["pos"], r["mdoc"], r["mpos"]) for r in cut.to_pylist() if r["n"] is None}
    assert more and {p for p in every if p[:2] in more} <= first | again


def test_token_counts(make_docs):
    rows = [(1, "a b a\nc"), (2, "B d"), (3, None), (4, "")]
    counts = {r.h: r.n for r in line_dedup.token_counts(make_docs(rows), "text", 2).collect()}
    a, b = line_dedup.hash_words(b"a b")[0].tolist()
    assert counts == {a: 2, b: 2}
