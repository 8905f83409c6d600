import hashlib
import zlib

import pytest

from kabuto.llm import merkle_manifest as M
from kabuto.llm.queries import queries

from .conftest import SF


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def value(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def tree(leaves):
    """All levels, and for every leaf what lies beside its way up (None: nothing)."""
    levels = [leaves]
    while len(levels[-1]) > 1:
        levels.append([h(*levels[-1][k : k + 2]) for k in range(0, len(levels[-1]), 2)])
    ways = []
    for i in range(len(leaves)):
        ways.append([(i >> k & 1, level[i >> k ^ 1] if i >> k ^ 1 < len(level) else "") for k, level in enumerate(levels[:-1])])
    return levels[-1][0], ways


def brute(rows):
    """rows: (doc_id, source, lang, n_chars, text)."""
    groups = {}
    for r in rows:
        groups.setdefault(r[2], []).append((r, h(*map(value, r))))
    langs = sorted(groups, key=lambda x: (x is not None, (x or "").encode()))
    for g in langs:
        groups[g].sort(key=lambda x: (x[0][0] is not None, x[0][0] or 0, x[1]))
    trees = {g: tree([leaf for _, leaf in groups[g]]) for g in langs}
    root, tops = tree([trees[g][0] for g in langs]) if langs else (None, [])
    out = []
    for g, top in zip(langs, tops, strict=True):
        for (r, leaf), way in zip(groups[g], trees[g][1], strict=True):
            hit = r[0] is not None and r[3] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0
            node = h(*map(value, (r[0], r[1], r[2], r[3] + 1, r[4]))) if hit else leaf
            for right, sibling in way + top:
                node = h(sibling, node) if right else h(node, sibling)
            out.append((r[0], leaf, trees[g][0], root, h(*[s for _, s in way + top]), node, node == root))
    return sorted(out, key=str)


def seen(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, leaf int, g string, `at` int"


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "x", 2) for r in rows], SCHEMA)


@pytest.mark.parametrize("block", [1, 2, 8])
def test_sizes_against_brute_force(spark, block, monkeypatch):
    """Groups of every size up to 20, and some that need several rounds of blocks."""
    monkeypatch.setattr(M, "LEVELS", block)
    monkeypatch.setattr(M, "BLOCK", 1 << block)
    sizes = [*range(1, 12), 16, 17, 33, 70] if block < 8 else [300, 1, 257]
    rows = [(n * 1000 + k, "s", f"l{n}", k, f"text {k}") for n in sizes for k in range(n)]
    assert seen(M.verify_documents(frame(spark, rows))) == brute(rows)


def test_odd_rows(spark):
    rows = [
        (1, None, None, None, None),
        (1, None, None, None, None),
        (1, None, None, None, ""),
        (None, "s", "", 3, "no id"),
        (None, "s", "", 3, "no id"),
        (7, "s", "é", 2**63 - 1, "ü" * 100_000),
        (-7, "s", "z", -1, "a\x00b"),
        (8, "", "\U0001f600", 0, "\U0001f600"),
    ]
    rows += [(5, "hot", "z", 5, "copy")] * 400
    assert seen(M.verify_documents(frame(spark, rows))) == brute(rows)
    assert M.verify_documents(frame(spark, rows).limit(0)).count() == 0
    for one in rows[:1], rows[5:6]:
        assert seen(M.verify_documents(frame(spark, one))) == brute(one)


def test_tampering_is_found_and_nothing_else(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = M.verify_documents(docs).collect()
    for r in out:
        assert r.verified == (zlib.crc32(str(r.doc_id).encode()) % 7 != 0)
    assert 0 < sum(not r.verified for r in out) < len(out) / 4


def test_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select(*M.COLUMNS).collect()]
    assert seen(queries()["op12_merkle_manifest"](spark, SF)) == brute(rows)
