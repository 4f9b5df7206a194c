import random
import re
import zlib
from collections import Counter, defaultdict

from helpers_llm import texts_of

from claimloom.llm import queries, spelling

RUN = re.compile("[A-Za-zÀ-ÿ]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def _counts(docs):
    total = Counter()
    for doc_id, text in docs:
        for run in RUN.findall(text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 97 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            total[run] += 1
    return {w: n for w, n in total.items() if len(w) >= 5 and n >= 3}


def _expected(docs):
    """Neighbours by words with a hole: a replaced, or left out, code point."""
    counts = _counts(docs)
    holes, lacking = defaultdict(set), defaultdict(set)
    for w in counts:
        for k in range(len(w)):
            holes[w[:k] + "\0" + w[k + 1 :]].add(w)
            lacking[w[:k] + w[k + 1 :]].add(w)
    near = defaultdict(set)
    for same in holes.values():
        for w in same:
            near[w] |= same - {w}
    for short, longer in lacking.items():
        if short in counts:
            near[short] |= longer
            for w in longer:
                near[w].add(short)
    form = {}
    for w, n in counts.items():
        best = min(near[w], key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best and counts[best] >= 2 * n else None

    def root(w):
        while form[w]:
            w = form[w]
        return w

    return {
        (w, form[w], root(w), n, len(near[w]), counts[form[w]] if form[w] else None) for w, n in counts.items()
    }


def _found(df):
    rows = [tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def test_query(spark, small):
    expected = _expected(texts_of(small))
    assert _found(queries.op13_spelling(spark, "/root/testdata/sf0.001")) == expected
    assert any(f and r != f for _, f, r, *_ in expected)


def test_words_of_all_lengths(spark):
    """Edits at every place of words of 5 to 70 letters, chains of forms, letters beyond ASCII."""
    draw = random.Random(7)
    rows = []
    for length in [*range(5, 24), 40, 70]:
        word = "".join(draw.choices("abéÿÀ×", k=length))
        group = {word}
        for k in range(length + 1):
            group |= {word[:k] + c + word[k:] for c in "aé"} | {word[:k] + c + word[k + 1 :] for c in "bÿ"}
            group.add(word[:k] + word[k + 1 :])
        for v in draw.sample(sorted(group), min(len(group), 40)):
            rows.append((len(rows), " ".join([v] * draw.choice([1, 3, 4, 7, 9, 20]))))
    rows.append((None, "aaaaaa " * 2 + "AAAAAA bbbbb1bbbbb_bbbbb " + "x" * 300_000 + " y" * 5))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert _found(spelling.variants(docs)) == _expected(rows)


def test_dense_group_and_flushes(spark):
    """Many words around one stem meet in small groups; counts of one word come from many parts."""
    draw = random.Random(9)
    rows = [(i, " ".join("stemm" + "".join(draw.choices("abcd", k=3)) for _ in range(50))) for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    counted = spelling.word_counts(docs, held_words=3).collect()
    assert {r.word: r.n for r in counted} == _counts(rows)
    assert _found(spelling.variants(docs)) == _expected(rows)


def test_odd_and_empty_rows(spark, odd, empty):
    assert _found(spelling.variants(odd)) == _expected(texts_of(odd))
    assert spelling.variants(empty).collect() == []


def test_one_part_holds_any_edit():
    """For each length every single edit lies within a part, and parts are few and small."""
    for length in range(5, 60):
        parts = spelling.damaged(length)
        assert len(parts) <= 16 and max(b - a for a, b in parts) <= max(2, length // 16 + 2)
        assert all(any(a <= k < b for a, b in parts) for k in range(length))
        assert all(any(a <= k <= b for a, b in parts) for k in range(length + 1))


def test_joins_gather_no_side_on_the_driver(spark, small, monkeypatch):
    """A word emits many chunks: its file is far smaller than what a broadcast would hold."""
    plans, stored = [], spelling.common.stored

    def seen(df, name):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return stored(df, name)

    monkeypatch.setattr(spelling.common, "stored", seen)
    found = spelling.variants(small)
    plans.append(found._jdf.queryExecution().executedPlan().toString())
    assert sum(plan.count("SortMergeJoin") for plan in plans) >= 4
    assert not [plan for plan in plans if "Broadcast" in plan]
