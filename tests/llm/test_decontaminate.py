import hashlib
import re

import numpy as np
import pytest

import __spark_entry__ as E
from kabuto.llm import decontaminate as D
from tools.compare import digest, duck

from .conftest import ODD, SF

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def fold(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items, window=13):
    out = []
    for i, text in docs:
        w = fold(text)
        hit, found = set(), set()
        for item, t in items:
            b = fold(t)
            size = min(window, len(b))
            windows = {tuple(b[k : k + size]) for k in range(len(b) - size + 1)} if size else set()
            for k in range(len(w) - size + 1):
                if tuple(w[k : k + size]) in windows:
                    hit.update(range(k, k + size))
                    found.add("null" if item is None else str(item))
        ids = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((i is None, i or 0, len(w), len(hit), len(found), ids, len(hit) > 0 and 20 * len(hit) >= len(w)))
    return sorted(out)


def seen(df):
    return sorted((r.doc_id is None, r.doc_id or 0, r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in df.collect())


@pytest.mark.parametrize("max_words", [D.MAX_WORDS, 40])
def test_against_brute_force(spark, max_words):
    phrase = " ".join(f"w{k % 7}" for k in range(20))
    items = [(1, phrase), (2, "only Two"), (10, "x " * 15), (None, "nobody"), (3, None), (4, ""), (5, "été 3"), (2, "only Two")]
    docs = [
        (1, "a " + phrase + " b"), (2, phrase[:-3]), (3, "ONLY-two! only two, only"), (4, "x " * 40), (5, None), (6, ""), (7, "nobody " + "z " * 100),
        (8, "Été 3 été,3"), (9, " ".join(f"w{k % 7}" for k in range(3000))), (11, "only"), (None, "two only two"),
    ]
    d, b = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    assert seen(D.decontaminate(d, b, max_words=max_words)) == brute(docs, items)


def test_passes_keep_rows_and_bounds(spark, monkeypatch):
    """Null and repeated ids in several passes; an item with all the words; a long text."""
    phrase = " ".join(f"w{k % 7}" for k in range(20))
    items = [(None, f"only{k} two{k} three{k}") for k in range(60)] + [(1, phrase), (2, " ".join(f"v{k}" for k in range(400)))]
    docs = [(None, "a only3 two3 three3"), (None, "b"), (None, phrase), (None, None), (4, "x only5 two5 three5 y"), (4, phrase + " b"), (4, "z " * 9), (4, "z " * 9)]
    docs += [(5, "q " + " ".join(f"v{k}" for k in range(3, 390)))]
    sizes = []
    made = D.Phrases.__init__

    def counted(self, items, window):
        sizes.append(sum(len(ws) for _, ws in items))
        made(self, items, window)

    monkeypatch.setattr(D.Phrases, "__init__", counted)
    d, b = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    assert seen(D.decontaminate(d, b, max_words=200)) == brute(docs, items)
    assert len(sizes) > 3 and max(sizes) <= 400
    names = [(None, "one two"), ("null", "one two")]
    b = spark.createDataFrame(names, "item_id string, text string")
    for max_words in (D.MAX_WORDS, 2):
        assert [r.n_items for r in D.decontaminate(spark.createDataFrame([(1, "one two")], "doc_id long, text string"), b, max_words=max_words).collect()] == [2]


def test_blocks_of_the_index(spark, monkeypatch, texts):
    items = [(k, " ".join(t.split()[3:30])) for k, t in texts[:50:3]]
    docs = spark.createDataFrame(texts, "doc_id long, text string").coalesce(1)
    b = spark.createDataFrame(items, "item_id long, text string")
    assert seen(D.decontaminate(docs, b)) == brute(texts, items)


def test_odd_rows_and_empty_tables(spark, odd):
    b = spark.createDataFrame([(1, "one two"), (2, "word word word")], "item_id long, text string")
    got = D.decontaminate(odd.withColumnRenamed("ids", "n_words"), b)
    assert seen(got) == brute(ODD, [(1, "one two"), (2, "word word word")])
    assert all(r[3:5] == (0, 0) for r in seen(D.decontaminate(odd, b.limit(0))))
    assert D.decontaminate(odd.limit(0), b).count() == 0


def test_proximity():
    rng = np.random.default_rng(1)
    for _ in range(60):
        line = rng.integers(0, 12, 200)
        lists = {t: np.flatnonzero(line == t) for t in range(12) if (line == t).any()}
        terms, span = [0, 5, 7], int(rng.integers(3, 12))
        rarest = min((t for t in terms), key=lambda t: len(lists.get(t, ())))
        rarest = sorted((lists[t] for t in terms), key=len)[0] if all(t in lists for t in terms) else None
        expected = [] if rarest is None else [p for p in rarest.tolist() if any(set(terms) <= set(line[max(0, s) : s + span].tolist()) for s in range(p - span + 1, p + 1))]
        assert D.near(lists, terms, span).tolist() == expected


@pytest.mark.parametrize("max_words", [D.MAX_WORDS, 30])
def test_proximity_matches_of_documents(spark, max_words):
    """Words reordered or inserted are found, in the whole text and in no other document's."""
    rng = np.random.default_rng(4)
    line = lambda n: " ".join(f"w{k}" for k in rng.integers(0, 14, n))
    items = [(1, "alpha beta gamma delta"), (2, line(9)), (3, line(4)), (None, "one word"), (4, "beta"), (5, None), (6, "alpha zzz")]
    docs = [(1, "x gamma y alpha beta z delta x"), (1, "x gamma y alpha beta z z z z z z delta"), (None, "alpha beta"), (None, "gamma delta"), (2, None), (3, ""), (4, "word or one")]
    docs += [(k, line(60)) for k in range(10, 30)]
    d, b = spark.createDataFrame(docs, "doc_id long, text string").coalesce(1), spark.createDataFrame(items, "item_id long, text string")
    window, span = 5, 8
    expected = []
    for i, t in docs:
        w, found = fold(t), set()
        for item, x in items:
            ws = fold(x)
            size = min(window, len(ws))
            for k in range(len(ws) - size + 1 if size else 0):
                if any(set(ws[k : k + size]) <= set(w[s : s + span]) for s in range(len(w))):
                    found.add("null" if item is None else str(item))
        expected.append((i or 0, len(w), sorted(found)))
    rows = D.find_near(d, b, window=window, span=span, max_words=max_words).collect()
    assert sorted((r.doc_id or 0, r.n_words, sorted(r["items"])) for r in rows) == sorted(expected)
    assert all(bool(r.hits) == bool(r["items"]) for r in rows) and sum(len(x[2]) for x in expected) > 8
    phrases = D.find_phrases(d, b, window=window, max_words=max_words).collect()
    assert [r for r in phrases if r.n_words == 8][0]["items"] == ["4"]  # by proximity item 1 too


def test_query_matches_sql(spark):
    con = duck(SF)
    for name in ("op3_benchmark_decontamination", "op7_chat_formatting"):
        df = E.queries()[name](spark, SF)
        cur = con.execute(E.oracle_sql()[name])
        columns = [c[0] for c in cur.description]
        assert sorted(columns) == sorted(df.columns)
        assert digest([tuple(r) for r in df.collect()], df.columns)[0] == digest(cur.fetchall(), columns)[0]
