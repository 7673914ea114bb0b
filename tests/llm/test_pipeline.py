"""The corpus pipeline stage by stage against its operators' brute force."""

import base64
import hashlib
import os
import re

import duckdb
import public_tokenizers
import pytest
import tiktoken

import corpus_pipeline
from dayledger.llm import decontaminate, langid, simhash
from dayledger.session import written

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
KINDS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def stages(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    out = [docs.cache()]
    for _, stage in corpus_pipeline.STAGES:
        out.append(written(stage(spark, out[-1], SF_DIR)).cache())
    return out


def _rows(df):
    return {r["doc_id"]: r for r in df.collect()}


def test_columns_stay(stages):
    for df in stages[1:-1]:
        assert df.columns == list(corpus_pipeline.COLUMNS)


def test_language_keeps_all_texts_with_letters(stages):
    before, after = _rows(stages[0]), _rows(stages[1])
    assert after == {k: r for k, r in before.items() if any(c.isalpha() for c in r["text"] or "")}


def test_one_of_each_group_stays(stages):
    before, after = _rows(stages[1]), _rows(stages[2])
    prints = {k: simhash.fingerprint(r["text"]) % (1 << 64) for k, r in before.items()}
    ids = sorted(prints)
    root = {k: k for k in ids}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for i, a in enumerate(ids):
        for b in ids[:i]:
            if (prints[a] ^ prints[b]).bit_count() <= 2:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    assert after == {k: before[k] for k in ids if find(k) == k}
    assert len(after) < len(before)


def test_no_benchmark_item_stays(stages):
    con = duckdb.connect()
    con.register("documents", stages[2].toPandas())
    con.execute(f"CREATE VIEW benchmark AS FROM '{SF_DIR}/benchmark.parquet'")
    bad = {r[0] for r in con.execute(decontaminate.OP10_SQL).fetchall()}
    before, after = _rows(stages[2]), _rows(stages[3])
    assert bad and after == {k: r for k, r in before.items() if k not in bad}


def test_personal_data_is_masked(stages):
    before, after = _rows(stages[3]), _rows(stages[4])
    assert before.keys() == after.keys()
    email = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
    changed = 0
    for k, r in after.items():
        old = before[k]
        assert not email.search(r["text"])
        assert r["n_chars"] == len(r["text"])
        assert (r["lang"], r["source"]) == (old["lang"], old["source"])
        if "[" not in r["text"]:
            assert r["text"] == old["text"]
        changed += r["text"] != old["text"]
    assert 0 < changed < len(after)


def test_tokens_decode_to_the_texts(stages):
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    reference = tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )
    before, after = _rows(stages[4]), _rows(stages[5])
    assert before.keys() == after.keys()
    for k, r in after.items():
        assert r["token_ids"] == reference.encode_ordinary(before[k]["text"])
        assert r["decoded_sha256"] == hashlib.sha256(before[k]["text"].encode()).hexdigest()


def test_odd_rows(spark):
    """Nulls in any column, repeated rows, equal ids, and columns with the stages' own names."""
    same = "alpha beta gamma delta epsilon zeta"
    rows = [
        (1, same, "en", "b", 3, 0), (1, same, "en", "a", 3, 0), (2, same, None, "a", 3, 0),
        (None, same, "en", None, 3, 0), (None, "other words are here now today", "en", None, 3, 0),
        (None, "other words are here now today", "en", "s", None, 0), (4, None, None, None, None, 0),
        (5, "", None, None, None, 0), (6, "12 !!", None, None, None, 0),
        (7, "call +1 (555) 555-1234 now", "en", None, None, 0), (8, "word " * 30_000, "en", "a", 1, 0),
    ]
    docs = spark.createDataFrame(rows, KINDS + ", fingerprint int")
    for _, stage in corpus_pipeline.STAGES[:4]:
        docs = written(stage(spark, docs, SF_DIR))
    found = sorted((str(r["doc_id"]), r["text"][:36], r["source"]) for r in docs.collect())
    assert found == [
        ("1", same, "a"), ("7", "call [PHONE] now", None), ("8", ("word " * 8)[:36], "a"),
        ("None", "other words are here now today", None),
    ]


def test_rows_that_share_a_doc_id_are_told_apart(spark):
    copied = "alpha beta gamma delta epsilon zeta"
    item = spark.read.parquet(f"{SF_DIR}/benchmark.parquet").orderBy("item_id").first()["text"]
    texts = [
        (3, copied), (5, copied), (5, "one clean text of its own"), (5, "another with nothing of that"),
        (7, "seven words that are clean and stay"), (7, item), (None, item + " and"),
        (None, "no name but clean words all along"), (None, "a second clean row without a name"),
        *((9, f"number {k} of many rows {k * k} that share {k + 7} one doc_id") for k in range(40)),
    ]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in texts], KINDS)
    prints = {t: simhash.fingerprint(t) for _, t in texts}
    assert all(
        ((a ^ b) % (1 << 64)).bit_count() > 2 for a in prints.values() for b in prints.values() if a != b
    )
    kept = written(corpus_pipeline.near_duplicates(spark, docs, SF_DIR))
    expected = [t for t in texts if t != (5, copied)]
    assert sorted(map(str, [(r["doc_id"], r["text"]) for r in kept.collect()])) == sorted(map(str, expected))
    clean = corpus_pipeline.decontamination(spark, kept, SF_DIR).collect()
    expected = [t for t in expected if item not in t[1]]
    assert sorted(map(str, [(r["doc_id"], r["text"]) for r in clean])) == sorted(map(str, expected))


def test_no_documents(spark):
    docs = spark.createDataFrame([], KINDS)
    for _, stage in corpus_pipeline.STAGES:
        docs = written(stage(spark, docs, SF_DIR))
        assert docs.count() == 0
    assert "token_ids" in docs.columns


def test_nothing_labelled_rejects_no_text(spark):
    docs = spark.createDataFrame([(1, "some words", None, None, 1), (2, "12", None, None, 1)], KINDS)
    assert langid.fit(docs).langs == []
    kept = corpus_pipeline.language(spark, docs, SF_DIR).collect()
    assert [r["doc_id"] for r in kept] == [1]
