import pytest

from comparing import DATA, same
from weftline.llm import queries as llm

SQL = llm.oracle_sql()


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_as_sql(spark, name):
    same(spark, name, llm.queries()[name], SQL[name])


@pytest.mark.parametrize("name", sorted(set(llm.queries()) - set(SQL)))
def test_runs_over_whole_tables(spark, name):
    assert llm.queries()[name](spark, DATA).count() > 0


def test_found_columns(spark):
    want = {"p1_found": ["field", "record_id"], "p2_found": ["field", "record_id", "ref_id"], "p3_found": ["line_id"], "p4_found": ["job_index"], "p5_found": ["field", "term", "mark"], "p6_found": ["skill_a", "skill_b"], "p7_found": ["field", "job_index", "term"], "p10_found": ["doc_id"]}
    for name, columns in want.items():
        assert llm.queries()[name](spark, DATA).columns == columns


def test_site_notices_need_no_dates_and_no_empty_lines(spark, tmp_path):
    """p3_found reads lines only, as its SQL does, and postings whose lines are null don't count in their source."""
    notice, article = "All rights reserved by this site", "One article that many ids republish"
    rows = [(f"n{p}", p, "s", f"{notice}{'!' * (p % 2)}") for p in range(3)] + [(f"u{p}", p, "s", "A line of its own in posting " + "abc"[p]) for p in range(3)]
    rows += [(f"a{p}", p, "s", article) for p in range(10, 14)] + [(f"e{p}", p, "s", None) for p in range(20, 60)] + [("none", None, "s", notice), ("two", 61, "t", notice)]
    spark.createDataFrame(rows + rows[:4], "line_id string, job_index bigint, source string, text string").toPandas().to_parquet(tmp_path / "parsed_lines.parquet")
    assert {r.line_id for r in llm.queries()["p3_found"](spark, str(tmp_path)).collect()} == {"n0", "n1", "n2", "none", "a10", "a11", "a12", "a13"}
    same(spark, "p3_found", llm.queries()["p3_found"], SQL["p3_found"], str(tmp_path))
