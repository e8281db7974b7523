from __future__ import annotations

import duckdb
import pytest

from tests.llm import brute
from tidemill.llm import mixing as M
from tidemill.llm.catalog import ORACLE


@pytest.mark.parametrize("sf", [brute.SMALL, brute.CHECK])
def test_query_equals_sql(spark, sf):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{sf}/documents.parquet'")
    rel = con.sql(ORACLE["op9_mix_sources"])
    want = sorted(rel.fetchall())
    rows = M.op9_mix_sources(spark, sf).select(*rel.columns).collect()
    assert sorted(tuple(r) for r in rows) == want


def test_targets():
    assert M.targets([], []) == [] and M.targets([0, 0], [3, 1]) == [0.0, 0.0]
    got = M.targets([100, 100, 1000], [3, 1, 2])
    assert got[:2] == [200.0, 200.0] and sum(got) == 1800.0
    assert M.targets([10, 0], [3, 1]) == [15.0, 0.0]


def test_taken_comes_near_and_reruns_agree(spark):
    rows = M.op9_mix_sources(spark, brute.CHECK).collect()
    again = M.op9_mix_sources(spark, brute.CHECK).collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, again))
    docs = brute.table("documents", brute.CHECK).set_index("doc_id")
    by_source = {}
    for r in rows:
        assert r["taken"] in (0, r["size"], 2 * r["size"])
        by_source.setdefault(docs.source[r["doc_id"]], []).append(r)
    for group in by_source.values():
        largest = max(r["size"] for r in group)
        assert abs(sum(r["taken"] for r in group) - group[0]["target"]) <= largest


def test_edges(spark, edge, empty):
    out = M.mix_sources(edge).collect()
    assert len(out) == edge.count()
    assert all(r["m_copies"] in (0, 1, 2) for r in out)
    twice = [r for r in out if r["m_id"] == 5]
    assert len(twice) == 2
    rows = M.mixed_rows(edge)
    assert rows.columns == edge.columns and rows.count() == sum(r["m_copies"] for r in out)
    assert M.mix_sources(empty).count() == 0 and M.mixed_rows(empty).columns == edge.columns


def test_one_hash_bucket_is_refined(spark):
    """Many small documents of one source: the threshold comes within half a document of the target."""
    frame = spark.range(20_000).selectExpr("id AS doc_id", "'a b c' AS text", "CAST(id % 2 AS STRING) AS source")
    rows = M.mix_sources(frame, weights=(3, 1)).groupBy("m_target").agg({"*": "count"}).collect()
    assert len(rows) == 2
    taken = M.mix_sources(frame, weights=(3, 1)).selectExpr("m_target", "m_copies * m_size AS t").groupBy("m_target").sum("t").collect()
    assert all(abs(r["m_target"] - r["sum(t)"]) <= 3 for r in taken)


def test_equal_rows_are_split_where_the_target_asks(spark, tmp_path, monkeypatch):
    """Half of a source is one row: the mix comes within a document of the target, and the SQL agrees."""
    monkeypatch.setattr(M, "REPEATS_A_TASK", 700)
    copies = 5001
    same, other = "the same five words here", "a b c d e"
    frame = spark.range(2 * copies).selectExpr(
        f"IF(id < {copies}, -1, id) AS doc_id", f"IF(id < {copies}, '{same}', '{other}') AS text", "'s' AS source", "'en' AS lang", "id % 2 AS n_chars"
    ).union(spark.sql(f"SELECT -2, '{same}', NULL, 'en', 0 FROM range({copies})"))
    frame.write.parquet(f"{tmp_path}/documents.parquet")
    frame = spark.read.parquet(f"{tmp_path}/documents.parquet")
    rows = M.op9_mix_sources(spark, str(tmp_path)).collect()
    assert len(rows) == 3 * copies
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    rel = con.sql(ORACLE["op9_mix_sources"])
    assert sorted(tuple(r[c] for c in rel.columns) for r in rows) == sorted(rel.fetchall())
    by_target = {}
    for r in rows:
        assert r["taken"] in (0, r["size"], 2 * r["size"])
        by_target.setdefault(r["target"], []).append(r["taken"])
    assert len(by_target) == 2 and all(abs(t - sum(v)) <= 2.5 for t, v in by_target.items())
    for share in (0.4, 1.3):  # the rest falls into the group or beside it
        mixed = M.mix_sources(frame, share=share).groupBy("m_target").agg({"m_copies": "sum"}).collect()
        assert all(abs(r["m_target"] - 5 * r["sum(m_copies)"]) <= 2.5 for r in mixed)
        out = M.mixed_rows(frame, share=share)
        assert out.columns == frame.columns
        got = {r["source"]: r["count"] for r in out.groupBy("source").count().collect()}
        assert sorted(got.values()) == sorted(r["sum(m_copies)"] for r in mixed)
        again = M.mixed_rows(frame.repartition(5), share=share)
        assert out.exceptAll(again).isEmpty() and again.exceptAll(out).isEmpty()


def test_rows_equal_in_id_and_text_only(spark):
    """What else the rows hold tells them apart, nulls in different places and maps included."""
    frame = spark.range(3001).selectExpr(
        "1 AS doc_id", "'a b' AS text", "'s' AS source", "IF(id % 2 = 0, 'v', NULL) AS x", "IF(id % 2 = 0, NULL, 'v') AS y", "map('k', id % 3) AS m"
    )
    out = M.mixed_rows(frame, share=0.5).selectExpr("x", "y", "m['k'] AS k")
    assert out.count() in (1500, 1501)
    again = M.mixed_rows(frame.repartition(7), share=0.5).selectExpr("x", "y", "m['k'] AS k")
    assert out.exceptAll(again).isEmpty() and again.exceptAll(out).isEmpty()
    kinds = {(r["x"], r["y"], r["k"]): r["count"] for r in out.groupBy("x", "y", "k").count().collect()}
    assert sum(n not in (500, 501) for n in kinds.values()) <= 1  # one group of equal rows is split at most
