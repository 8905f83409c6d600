"""Every stage against a brute-force version over its own input."""

import duckdb
import pytest
import sentencepiece

import corpus_pipeline as P
from kabuto.llm import pieces
from kabuto.llm import secret_scan as S
from kabuto.llm import toxicity as T
from kabuto.llm.common import prepare, written

from .conftest import SF
from .test_decontaminate import brute as brute_windows
from .test_ngram_join import brute as brute_components


@pytest.fixture(scope="module")
def stages(spark):
    docs = prepare(spark).read.parquet(f"{SF}/documents.parquet")
    out = [docs]
    for name, stage in P.STAGES:
        out.append(written(stage(spark, out[-1], SF), name))
    return out


def texts(df):
    return sorted((r.doc_id, r.text) for r in df.select("doc_id", "text").collect())


def test_columns_and_oracle(stages):
    assert [n for n, _ in P.STAGES] == ["toxicity", "ngram_jaccard_join", "benchmark_decontamination", "secret_scans", "sentencepiece"]
    assert all(df.columns == stages[0].columns for df in stages[:-1]) and P.ORACLE_SQL is None


def test_toxic_documents_go(spark, stages):
    from pyspark.sql import functions as F

    labels = spark.read.parquet(f"{SF}/labels.parquet")
    model = T.fit(stages[0], labels.where(~T.held_out(F.col("doc_id"))))
    assert texts(stages[1]) == [(i, t) for i, t in texts(stages[0]) if model.score(t, {}) < P.TOXIC]


def test_one_of_each_component_stays(stages):
    before = texts(stages[1])
    keep = {i for (_, i), _, (_, low) in brute_components(before) if i == low}
    assert texts(stages[2]) == [(i, t) for i, t in before if i in keep]


def test_contaminated_documents_go(stages):
    items = duckdb.connect().execute(f"SELECT item_id, text FROM '{SF}/benchmark.parquet'").fetchall()
    before = texts(stages[2])
    bad = {r[1] for r in brute_windows(before, items) if r[-1]}
    assert bad and texts(stages[3]) == [(i, t) for i, t in before if i not in bad]


def test_secrets_are_masked(stages):
    before, after = dict(texts(stages[3])), dict(texts(stages[4]))
    assert before.keys() == after.keys()
    for i, t in before.items():
        assert not S.rule_spans(after[i]) and ((after[i] == t) or "[SECRET]" in after[i])
    assert stages[4].where("n_chars <> char_length(text) AND text LIKE '%[SECRET]%'").count() == 0


def test_ids(stages):
    library = sentencepiece.SentencePieceProcessor(model_proto=pieces.read_model())
    rows = {r.doc_id: r for r in stages[5].collect()}
    for i, t in texts(stages[4]):
        assert rows[i].ids == library.encode(t) and rows[i].same


def test_run_gives_the_last_stage(spark, stages):
    got = sorted((r.doc_id, r.n_tokens) for r in P.run(spark, SF).collect())
    assert got == sorted((r.doc_id, r.n_tokens) for r in stages[5].collect())


CLASHING = "doc_id long, text string, lang string, source string, n_chars long, masked string, `__text` string, key string"


def test_odd_rows_through_every_stage(spark):
    """Null and empty texts and ids, repeated rows and ids, a long text, clashing columns."""
    from .conftest import ODD

    rows = [(i, t, None, "s", len(t) if t else None, "m", "t", "k") for i, t in ODD]
    rows += [(20 + k, f"some plain words of text number {k} and more", "en", "s", 1, None, None, None) for k in range(30)]
    rows += [(70, None, None, None, None, None, None, None), (71, "12 34", None, None, None, None, None, None), (72, "password=hunter2222 is here", "en", "s", 26, "m", "t", "k")]
    docs = spark.createDataFrame(rows, CLASHING)
    kept = [docs]
    for name, stage in P.STAGES[:-1]:
        kept.append(written(stage(spark, kept[-1], SF), name))
        assert kept[-1].columns == docs.columns
    assert {r[:1] + r[5:] for r in map(tuple, kept[-1].collect())} <= {(r[0], *r[5:]) for r in rows}
    first = sorted((r.doc_id is None, r.doc_id or 0, r.text or "") for r in kept[1].collect())
    for odd in [(False, 1, ""), (False, 2, ""), (False, 3, "   \n\t "), (False, 70, ""), (False, 71, "12 34")]:
        assert odd in first  # nothing said, nothing toxic
    assert sum(r.doc_id == 4 for r in kept[2].collect()) == 1  # "one two" twice and once in capitals
    last = {r.doc_id: r for r in kept[-1].collect()}
    assert "hunter2222" not in last[72].text and last[72].n_chars == len(last[72].text) and last[72].masked == "m"
    out = P.STAGES[-1][1](spark, kept[-1], SF).collect()
    assert len(out) == kept[-1].count() and all(r.same for r in out)


def test_empty_table_through_every_stage(spark):
    docs = spark.createDataFrame([], CLASHING)
    for _, stage in P.STAGES:
        docs = written(stage(spark, docs, SF), "empty")
        assert docs.count() == 0
