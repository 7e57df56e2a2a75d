"""The queries that SQL can express against that SQL: on the smallest tables, and on rows those tables lack."""

import os

import duckdb
import pytest
from check_oracles import _rows, compare
from tidelog.llm.oracles import ORACLES
from tidelog.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"

PAGES = [
    (1, "http://a.net/x", '<link rel="canonical" href="http://www.example.org/es/y">'),
    (2, "https://a.net/x#part", "<p>no link of its own</p>"),
    (3, "http://b.net/", "<META http-equiv=refresh content='0; url=/old?n=1&amp;m=2'>"),
    (4, "http://b.net/old?n=1&m=2", '<link href="//c.net/z" rel="nofollow canonical"/>'),
    (5, "http://c.net/z", "<link rel=canonical href=z2>"),
    (6, "http://c.net/z2", '<!-- <link rel="canonical" href="http://x.org/"> --><link rel="canonical" href="http://shop.com/de/1">'),
    (7, "http://SHOP.com/de/1?q", None),
    (8, "http://shop.com/fr/1", '<link rel="canonical" href="http://d.net/q">'),
    (9, "http://d.net/q", '<link rel="canonical" href="http://a.net/x">'),
    (10, "http://e.net/q", '<link rel="canonical" href="mailto:x"><link rel="canonical" href="#top"><link rel="icon" href="http://x.org/">'),
    (11, "http://f.net", '<link rel="canonical" href="?page=2">'),
    (12, "http://f.net?page=2", '<link rel="canonical" href="http://example.org/en/1">'),
    (13, None, '<link rel="canonical" href="http://x.org/">'),
    (14, "no scheme", ""), (15, "http://notexample.org/es/", ""), (16, "http://example.org/en/12", ""),
    (1, "http://a.net/x", '<link rel="canonical" href="http://www.example.org/es/y">'),
]
DOCUMENTS = [(i, f"Shared by all\nonly in {i}\n  Shared by all \n\n", f"s{i % 11}") for i in range(22)] + [
    (40, None, "s1"), (41, "", "s1"), (42, "Shared by all", "s3"), (43, "é" * 300 + "\n" + "word " * 900, None),
    (44, "a b c d", "s1"), (45, "A B c\td", "s1"), (46, "   ", "s2"), (47, "a b c d e", None), (48, "a  b c d E f", "s5"),
    (51, "Straße straße STRAße strase strasen strase strase\nüberall überal überall überall überall überall überal überal", "s1"),
    (49, "word " * 900, "s9"), (50, "one two three four five six seven", "s1"),
]
VECTORS = [(i, [((i * 7 + k * 3) % 11 - 5) / 7 for k in range(4)]) for i in range(0, 120, 5)] + [
    (50_000, None), (50_050, [1.0, None, 0.0, 0.0]), (50_100, [float("nan"), 0.0, 0.0, 0.0]), (50_150, [0.5, 0.25, -0.5, 1.0])]
FIXTURES = {
    "pages": (PAGES, "page_id long, url string, html string"),
    "documents": (DOCUMENTS, "doc_id long, text string, source string"),
    "embeddings": (VECTORS, "vec_id long, embedding array<float>"),
}
OF = {"op2_redirect_filter": "pages", "op4_cover_tree_topk": "embeddings", "op5_stratified_shards": "documents",
      "op8_minhash_dedup": "documents", "op9_line_spread": "documents",
      "op13_two_way_spelling": "documents"}


@pytest.mark.skipif(not os.path.isdir(SF), reason="test data not mounted")
def test_given_tables(spark):
    outcomes = compare(spark, SF, list(ORACLES))
    assert {n: o for n, o in outcomes.items() if not o.startswith("ok")} == {} and set(outcomes) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(OF))
def test_rows_the_given_tables_lack(spark, tmp_path, name):
    rows, schema = FIXTURES[OF[name]]
    spark.createDataFrame(rows, schema).coalesce(2).write.parquet(f"{tmp_path}/{OF[name]}.parquet")
    out = QUERIES[name](spark, str(tmp_path))
    got = _rows(out.columns, [tuple(r) for r in out.collect()])
    con = duckdb.connect()
    con.execute(f"create view {OF[name]} as select * from '{tmp_path}/{OF[name]}.parquet/*.parquet'")
    cursor = con.execute(ORACLES[name])
    assert got == _rows([d[0] for d in cursor.description], cursor.fetchall())


def test_aliases_carry_verdicts_in_the_fixture(spark, tmp_path):
    rows, schema = FIXTURES["pages"]
    spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/pages.parquet")
    found = {r["page_id"]: (r["verdict"], r["by"]) for r in QUERIES["op2_redirect_filter"](spark, str(tmp_path)).collect()}
    assert found[1] == found[2] == found[9] == ("allow", "alias")  # one alias is allowed, one blocked
    assert found[3] == found[4] == found[5] == found[6] == ("block", "alias")
    assert found[11] == found[12] == ("block", "alias") and found[10] == found[14] == ("allow", "none")
