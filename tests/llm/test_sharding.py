from collections import Counter

import pytest

from kabuto.llm import sharding as S


def test_even_and_stable():
    names = [f"s{k}" for k in range(20)]
    table = S.lookup_table(names, 1009)
    sizes = Counter(table)
    assert max(sizes.values()) - min(sizes.values()) <= 1 and len(sizes) == 20
    fewer = S.lookup_table(names[:-1], 1009)
    moved = sum(a != b for a, b in zip(table, fewer, strict=True) if a != 19)
    assert moved < 0.15 * 1009
    shuffled = names[::-1]
    assert [shuffled[k] for k in S.lookup_table(shuffled, 1009)] == [names[k] for k in table]


def test_turns_follow_the_preferences():
    """Against a plain simulation over whole preference lists."""
    import hashlib

    names, size = ["b", "a", "c"], 13
    order = {}
    for n in names:
        d = hashlib.sha256(n.encode()).digest()
        offset, step = int.from_bytes(d[:8], "big") % size, int.from_bytes(d[8:16], "big") % (size - 1) + 1
        order[n] = [(offset + k * step) % size for k in range(size)]
        assert sorted(order[n]) == list(range(size))
    taken = {}
    while len(taken) < size:
        for n in sorted(names):
            if len(taken) < size:
                taken[next(s for s in order[n] if s not in taken)] = n
    assert [names[k] for k in S.lookup_table(names, size)] == [taken[s] for s in range(size)]


@pytest.mark.parametrize("names, size", [([], 13), (["a", "a"], 13), (["a"], 12), (["a", "b", "c"], 2)])
def test_refused(names, size):
    with pytest.raises(ValueError):
        S.lookup_table(names, size)


def test_rows(spark, odd):
    import hashlib

    names = [f"s{k}" for k in range(5)]
    out = S.assign_shards(odd.withColumnRenamed("key", "slot"), names, "doc_id", 1009)
    rows = out.collect()
    assert len(rows) == odd.count() and out.columns == ["doc_id", "text", "ids", "n_tokens", "slot", "shard"]
    table = S.lookup_table(names, 1009)
    for r in rows:
        slot = int(hashlib.md5(str("" if r.doc_id is None else r.doc_id).encode()).hexdigest()[:15], 16) % 1009
        assert (r.slot, r.shard) == (slot, names[table[slot]])
    assert S.assign_shards(odd.limit(0), names, "doc_id", 1009).count() == 0


def test_written_shards(spark, odd, tmp_path):
    path = str(tmp_path / "shards")
    S.write_shards(odd, path, ["a", "b"], "doc_id", 2, 101)
    assert spark.read.parquet(path).count() == odd.count()
