import hashlib
import random
import re

import pytest
from helpers_llm import texts_of

from claimloom.llm import decontamination

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def _words(text):
    return WORD.findall((text or "").translate(LOWER))


def _expected(docs, items, window=10):
    """(words, hit words, items) of each document, in order."""
    windows = {}
    for item, text in items:
        w = _words(text)
        for k in range(max(len(w) - window, 0) + 1 if w else 0):
            windows.setdefault(tuple(w[k : k + window]), set()).add(item)
    out = []
    for doc_id, text in docs:
        w, hit, found = _words(text), set(), set()
        for n in {len(p) for p in windows}:
            for k in range(len(w) - n + 1):
                if (part := tuple(w[k : k + n])) in windows:
                    hit |= set(range(k, k + n))
                    found |= windows[part]
        out.append((doc_id, len(w), len(hit), sorted(str(i) for i in found if i is not None)))
    return sorted(out, key=repr)


def _found(df):
    rows = df.select("doc_id", "n_words", decontamination.n_hit().alias("n_hit"), "items").collect()
    return sorted(((r.doc_id, r.n_words, r.n_hit, r.items) for r in rows), key=repr)


def _case(seed):
    draw = random.Random(seed)
    word = lambda: "".join(draw.choices("abAé9", k=draw.choice([1, 2, 12])))
    text = lambda n: draw.choice([" ", ", ", "\n"]).join(word() for _ in range(draw.randint(0, n)))
    items = [(i, text(draw.choice([3, 9, 40]))) for i in range(30)]
    items += [(7, text(30)), (None, text(30)), (None, None), (90, None), (91, " ,"), (92, items[0][1])]
    docs = [(i, " ".join([text(30), draw.choice(items)[1] or "", text(30)])) for i in range(60)]
    docs += [(1, docs[1][1]), (None, docs[2][1]), (None, None), (80, ""), (81, items[3][1].upper())]
    return docs, items


@pytest.mark.parametrize("seed", range(3))
def test_against_plain_search(spark, seed):
    docs, items = _case(seed)
    frame = spark.createDataFrame([(*d, "x", 1) for d in docs], "doc_id long, text string, items string, n_words int")
    benchmark = spark.createDataFrame([(*i, 1) for i in items], "item_id long, text string, doc_id long")
    expected = _expected(docs, items)
    assert _found(decontamination.occurrences(frame, benchmark)) == expected
    # The same in many passes over a benchmark of many blocks.
    assert _found(decontamination.occurrences(frame, benchmark, block_bytes=600)) == expected
    clean = decontamination.decontaminated(frame, benchmark)
    assert clean.columns == frame.columns
    hit = {i for i, _, n, _ in expected if n}
    assert sorted(map(repr, texts_of(clean))) == sorted(
        repr(d) for d in docs if not any(n for i, _, n, _ in _expected([d], items))
    )
    assert hit


def test_windows_of_long_items_cross_stretches(spark):
    item = " ".join(f"q{i}" for i in range(60))
    docs = [(i, " ".join(f"q{j}" for j in range(i, i + 12))) for i in range(55)]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    benchmark = spark.createDataFrame([("long", item)], "item_id string, text string")
    assert _found(decontamination.occurrences(frame, benchmark, stretch=7)) == _expected(docs, [("long", item)])


def test_odd_and_empty_tables(spark, odd, empty):
    items = [(5, "quick brown fox"), (6, "w1 two"), (8, "ONE"), (9, "ünïcödé")]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    expected = _expected(texts_of(odd), items)
    assert _found(decontamination.occurrences(odd, benchmark)) == expected and any(n for _, _, n, _ in expected)
    none = benchmark.limit(0)
    assert {n for _, _, n, _ in _found(decontamination.occurrences(odd, none))} == {0}
    assert decontamination.occurrences(empty, benchmark).collect() == []


def test_lockstep_of_any_width(monkeypatch):
    """Stretches of all lengths, very short and equal windows, blocks that no text has."""
    draw = random.Random(3)
    for _ in range(150):
        monkeypatch.setattr(decontamination, "LANES", draw.choice([1, 3, 4096]))
        text = lambda n: " ".join("".join(draw.choices("ab", k=draw.randint(1, 3))) for _ in range(draw.randint(0, n)))  # noqa: B023, E731
        items, texts, window = [(i, text(12)) for i in range(6)], [text(80) for _ in range(4)] + [""], draw.choice([1, 2, 10])
        made = decontamination.Items.of([([str(i)], t) for i, t in items if t], window)
        found = [(n, sum(b - a for a, b in r), own) for n, r, own in made.occurrences([t.encode() for t in texts])]
        assert sorted((k, *f) for k, f in enumerate(found)) == _expected(list(enumerate(texts)), items, window)


def test_digest_of_no_items_is_that_of_an_empty_text(spark):
    from claimloom.llm import queries

    rows = queries.op11_decontamination(spark, "/root/testdata/sf0.001").collect()
    clean = [r for r in rows if not r.contaminated]
    assert clean and {(r.n_hit, r.n_items, r.items_sha256) for r in clean} == {(0, 0, hashlib.sha256(b"").hexdigest())}
    assert any(r.contaminated and r.n_hit >= 10 and r.n_items for r in rows)
