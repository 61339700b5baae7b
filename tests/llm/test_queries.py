"""The registered queries on the smallest tables: against SQL where it can express them, else against plain Python."""

import base64
import hashlib

import pytest
from check_oracles import DATA, compare, duck

from callsift.llm import html_content, queries

FOLDER = DATA / "sf0.001"
pytestmark = pytest.mark.skipif(not FOLDER.exists(), reason="no test data")


@pytest.fixture(scope="module")
def con():
    return duck(FOLDER)


def rows(con, sql):
    return con.execute(sql).fetchall()


@pytest.mark.parametrize("name", list(queries.ORACLES))
def test_against_sql(spark, con, name):
    outcome = compare(spark, con, name, queries.QUERIES[name], queries.ORACLES[name], FOLDER)
    assert outcome.startswith("ok"), outcome


def test_there_are_thirteen(spark):
    assert [int(n.split("_")[0][2:]) for n in queries.QUERIES] == list(range(1, 14))


def test_tokens(spark, con):
    tiktoken = pytest.importorskip("tiktoken")
    path, pattern = queries.tokenizer()
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    reference = tiktoken.Encoding("test", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    got = {r["doc_id"]: r for r in queries.op1_byte_bpe(spark, str(FOLDER)).collect()}
    for i, text in rows(con, "SELECT doc_id, coalesce(text, '') FROM documents"):
        ids = reference.encode_ordinary(text)
        assert got[i]["n_tokens"] == len(ids)
        assert got[i]["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert got[i]["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()


def test_languages_by_held_out_accuracy(spark, con):
    got = queries.op10_language_id(spark, str(FOLDER)).filter("held_out").collect()
    truth = dict(rows(con, "SELECT doc_id, lang FROM documents"))
    assert sum(truth[r["doc_id"]] == r["lang_pred"] for r in got) >= 0.93 * len(got) > 0


def test_pages_have_a_row_each(spark, con):
    got = {r["page_id"]: r["text"] for r in queries.op4_html_content(spark, str(FOLDER)).collect()}
    for i, page in rows(con, "SELECT page_id, html FROM pages"):
        assert got[i] == html_content.extract(page) and got[i]


def test_shards(spark, con):
    got = queries.op9_sharding(spark, str(FOLDER)).collect()
    want = dict(rows(con, "SELECT doc_id, strlen(coalesce(text, '')) + 16 FROM documents"))
    assert {r["doc_id"]: r["size"] for r in got} == want
    assert {r["shard"] for r in got} == set(range(40))
    by_text, texts = {}, dict(rows(con, "SELECT doc_id, text FROM documents"))
    for r in got:
        by_text.setdefault(texts[r["doc_id"]], set()).add(r["shard"])
    assert all(len(s) == 1 for s in by_text.values())


def test_toxicity_and_fingerprints_have_a_row_each(spark, con):
    n = rows(con, "SELECT count(*) FROM documents")[0][0]
    scored = queries.op3_toxicity(spark, str(FOLDER)).collect()
    assert len(scored) == n and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for r in scored)
    made = queries.op5_fingerprints(spark, str(FOLDER)).collect()
    assert len(made) == n
    by_text, texts = {}, dict(rows(con, "SELECT doc_id, text FROM documents"))
    for r in made:
        by_text.setdefault(texts[r["doc_id"]], set()).add(r["fingerprint"])
    assert all(len(s) == 1 for s in by_text.values())
    assert sum(r["near_edited"] for r in made) > 10 * sum(r["near_next"] for r in made)
