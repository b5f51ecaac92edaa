from pyspark.sql import functions as F

from weftline.functions import text as T
from weftline.operators import candidates, grounding, lines


def one(spark, value, expression):
    return spark.createDataFrame([(value,)], "x string").select(expression(F.col("x")).alias("y")).first().y


def jobs(spark, texts):
    return spark.createDataFrame([(i, f"a {i}", t) for i, t in enumerate(texts)], "job_index bigint, id string, description_raw string")


def test_normalize(spark):
    assert one(spark, "a \t b\r\n  c \rd\n\n e", T.normalize_text) == "a b\nc\nd\n\ne"
    assert one(spark, None, T.normalize_text) == ""


def test_headings_are_rewritten_one_after_another(spark):
    got = [r.section + ":" + r.text for r in lines.segment(lines.describe(jobs(spark, ["We build. Preferred Qualifications: Go"]))).orderBy("line_index").collect()]
    assert got == ["body:We build.", "body:Preferred", "qualifications:Qualifications: Go"]
    assert one(spark, "a\n\nRequirements: x", lambda c: T.split_headings(c)) == "a\nRequirements: x"


def test_first_text_takes_strings_only(spark):
    df = spark.createDataFrame([(123, "  ", "fallback", "own")], "description_raw int, description string, job_description string, posting string")
    assert df.select(T.first_text(df.columns, dict(df.dtypes), T.DESCRIPTION_KEYS)).first()[0] == "own"
    blank = spark.createDataFrame([(" ", "x")], "description_raw string, job_description string")
    assert blank.select(T.first_text(blank.columns, dict(blank.dtypes), T.DESCRIPTION_KEYS)).first()[0] == "x"


def test_headers_and_labels(spark):
    heads = {"Minimum qualifications": "requirements", "Minimum Qualifications: x": "qualifications", "Experience: x": "qualifications", "Equal opportunity for all": "legal", "What you'll do": "responsibilities", "Our benefits package:": "benefits", "plain": None, "": None}
    for line, section in heads.items():
        assert one(spark, line, T.section_header) == section, line
    labels = {"401k and dental": "likely_benefits", "Apply now": "likely_boilerplate", "a rockstar": "likely_marketing", "a rockstar in python": "uncertain", "skills": "uncertain", "skill in x": "skills_relevant", "": "likely_boilerplate", "EEOC notice": "likely_legal"}
    for line, label in labels.items():
        assert one(spark, line, lambda c: T.line_label(c, F.lit("body"))) == label, line


def test_offsets_point_into_the_text(spark):
    d = lines.describe(jobs(spark, ["Über 😀 uns\nRequirements:\n- x", "", "one"]))
    rows = lines.segment(d).join(d.select("job_index", "description_normalized"), "job_index").collect()
    assert rows and all(r.description_normalized[r.char_start : r.char_end] == r.text for r in rows)
    assert {r.job_index for r in rows} == {0, 2}


def test_quality(spark):
    d = lines.describe(jobs(spark, ["", "short", "Requirements:\n" + "\n".join(f"{i} years of experience with tool {i} in production" for i in range(20))]))
    got = {r.job_index: r.quality_assessment for r in T.with_quality(d).collect()}
    assert got[0].status == "malformed" and got[0].quality_score == 0.0
    assert got[1].status == "truncated_or_broken"
    assert got[2].status == "complete" and got[2].features.skillish_line_count == 20


# Lines pinned by hand: what the SQL of the queries can't show, as it takes its patterns from the same values.
PINNED_LABELS = {
    "We are an equal opportunity employer.": "likely_legal",
    "Reasonable accommodation is available on request": "likely_legal",
    "Veteran status and gender identity are protected": "likely_legal",
    "Health insurance, dental and vision": "likely_benefits",
    "Unlimited vacation and a gym membership": "likely_benefits",
    "paid time off " + "x" * 300: "uncertain",
    "No phone calls, please": "likely_boilerplate",
    "Submit your resume today": "likely_boilerplate",
    "A fast-paced place with a passionate team": "likely_marketing",
    "A world-class place for SQL": "uncertain",
    "5 years of bookkeeping": "skills_relevant",
    "Experience required: welding": "skills_relevant",
    "Hands-on person wanted": "skills_relevant",
    "Bachelor or master": "skills_relevant",
    "Working with AB testing": "skills_relevant",
    "The office is in Porto": "uncertain",
}
PINNED_SECTIONS = {
    "Requirements": "requirements",
    "Required Qualifications:": "requirements",
    "Nice to have": "preferred",
    "Preferred qualifications: Rust": "preferred",
    "Skills and Experience": "qualifications",
    "Qualifications: a degree": "qualifications",
    "Key responsibilities:": "responsibilities",
    "Responsibilities: lead": "responsibilities",
    "About the role": "about",
    "Perks": "benefits",
    "Diversity at our firm": "legal",
    "Education: BSc": "education",
    "Position summary": "overview",
    "What we require, the qualification part:": "qualifications",
    "We list requirements below": None,
    "Summary of the plan": None,
}


def test_pinned_lines(spark):
    rows = spark.createDataFrame([(x,) for x in {**PINNED_LABELS, **PINNED_SECTIONS}], "x string")
    got = {r.x: (r.label, r.section) for r in rows.select("x", T.line_label(T.strip(F.col("x")), F.lit("body")).alias("label"), T.section_header(T.strip(F.col("x"))).alias("section")).collect()}
    assert {x: got[x][0] for x in PINNED_LABELS} == PINNED_LABELS
    assert {x: got[x][1] for x in PINNED_SECTIONS} == PINNED_SECTIONS


def test_segmentation_is_linear_in_meaning(spark):
    texts = ["Requirements:\na\nBenefits:\nb\n", "\n\nx", "no heading", "é😀\nEducation:\n" + "\n".join("y" * i for i in range(300))]
    got = {}
    for r in lines.segment(lines.describe(jobs(spark, texts), split=False)).orderBy("job_index", "line_index").collect():
        got.setdefault(r.job_index, []).append((r.line_index, r.section, r.text, r.char_start, r.char_end))
    for i, t in enumerate(texts):
        t, at, section, want = t.strip(), 0, "body", []
        for n, x in enumerate(t.split("\n")):
            section = {"Requirements:": "requirements", "Benefits:": "benefits", "Education:": "education"}.get(x, section)
            want.append((n, section, x, at, at + len(x)))
            at += len(x) + 1
        assert got[i] == want


def test_chunks_and_split(spark):
    texts = ["a" * 3000 + "\n" + "b" * 3000 + "\n" + "c" * 10, "\n".join(["a"] * 50), "Requirements:\n" + "x" * 2600 + "\nEducation:\ny", ""]
    d = lines.describe(jobs(spark, texts), split=False)
    got = {}
    for r in lines.chunks(d).orderBy("job_index", "line_id").collect():
        got.setdefault(r.job_index, []).append(r.chunk)
    assert got == {0: [0, 1, 1], 1: [0] * 24 + [1] * 24 + [2] * 2, 2: [0, 0, 1, 1]}
    parts = {}
    for r in lines.chunk_texts(d).orderBy("job_index", "chunk").collect():
        parts.setdefault(r.job_index, []).append(r.text)
    assert {i: "\n".join(p) for i, p in parts.items()} == {i: t for i, t in enumerate(texts) if t}
    assert lines.split_near_middle("One two. Three four.") == ("One two.", "Three four.")
    assert lines.split_near_middle("aaa bbbb") == ("aaa", "bbbb")
    assert lines.split_near_middle("x" * 10) == ("x" * 5, "x" * 5)
    assert lines.split_near_middle("x") is None and lines.split_near_middle("") is None


def test_inspection_shows_what_a_model_sees(spark):
    labelled = lines.label(lines.segment(lines.describe(jobs(spark, ["Skills in Go\nEqual opportunity employer\n\nx"]), split=False)))
    assert [(r.line_index, r.shown) for r in lines.inspect(labelled, 0).collect()] == [(0, True), (1, False), (2, False), (3, False)]  # the heading holds on


def test_starts(spark):
    rows = [("aaa", "aa", [0, 1]), ("xabab", "ab", [1, 3]), ("abab", "ab", [0, 2]), ("a.b", ".", [1]), ("😀a😀", "a", [1]), ("x\\Ey", "\\E", [1]), ("abc", "", []), ("abc", "z", [])]
    df = spark.createDataFrame([r[:2] for r in rows], "t string, s string")
    assert [r[0] for r in df.select(T.starts(F.col("t"), F.col("s"))).collect()] == [r[2] for r in rows]


def mined(spark, line, section, label, start=0):
    df = spark.createDataFrame([(1, "L", section, line, label, start)], "job_index bigint, line_id string, section string, text string, boilerplate_label string, char_start int")
    return [(r.candidate_text, r.char_start, r.char_end, r.rule_source) for r in candidates.mine(df).orderBy("ordinal").collect()]


def test_mining(spark):
    assert mined(spark, "Experience with Apache Spark and SQL.", "body", "skills_relevant", 100)[0] == ("Apache Spark and SQL", 116, 136, "experience_with_pattern")
    line = "Tools: Spark, dbt, C++ and K8s"
    got = mined(spark, line, "requirements", "uncertain")
    assert {g[0] for g in got} >= {"Spark", "dbt"} and all(line[a:b] == t for t, a, b, _ in got)
    assert mined(spark, "About us: a nice place to be", "about", "uncertain") == []
    assert [g[3] for g in mined(spark, "Stack used here: the JVM", "body", "uncertain")] == ["post_colon_fragment"]
    # a fragment that is not on the line as it is falls into its members, at all their places
    assert mined(spark, "Go, Go\u00a0\u00a0and Rust: experience with Go,\u00a0\u00a0Rust", None, "uncertain")[:2] == [("Go", 0, 2, "experience_with_pattern"), ("Go", 4, 6, "experience_with_pattern")]
    assert mined(spark, None, None, "uncertain") == [] and mined(spark, "", "requirements", None) == []
    assert mined(spark, "x" * 50_000 + ", Go", "requirements", "uncertain") == []


def test_rule_counts_are_those_of_the_patterns(spark):
    import re

    d = lines.describe(jobs(spark, ["Experience with Go\nMust have: Rust\nstrong SQL skills\nNice to have: X", "required Y. preferred: Z"]))
    labelled = lines.label(lines.segment(d)).cache()
    texts = [r.text for r in labelled.collect() if not (r.boilerplate_label in ("likely_legal", "likely_benefits") and len(r.text) < 200)]
    want = {k: sum(len(re.findall(p, t, re.I)) for t in texts) for k, p in candidates.PATTERNS.items()}
    assert {r.rule_source: r.n_matches for r in candidates.rule_counts(labelled).collect()} == want


def test_grounding(spark):
    rows = [(1, 0, "L1", "body", "SQL and sql"), (1, 1, "L2", "requirements", "know SQL"), (2, 0, "L3", None, "nothing here")]
    ls = spark.createDataFrame(rows, "job_index bigint, line_index int, line_id string, section string, text string").withColumns({"boilerplate_label": F.lit("uncertain"), "char_start": F.lit(10)})
    asked = [(1, 0, "SQL", "", "Requirements"), (1, 1, "SQL", "", "requirements"), (1, 2, "SQL", None, "requirements"), (1, 3, "Sql", "", None), (1, 4, "Go", "", "General"), (1, 5, " ", "", ""), (1, 6, "know", "know SQL", "body"), (2, 0, "SQL", "", ""), (3, 0, "SQL", "", ""), (1, 7, "S", "know", "body")]
    m = spark.createDataFrame(asked, "job_index bigint, mention_idx int, skill_span string, context string, section_hint string")
    got = {r.mention_idx: (r.line_id, r.line_char_start, r.char_end, r.offset_valid) for r in grounding.ground(m, ls).collect()}
    assert got == {0: ("L2", 5, 18, True), 1: ("L1", 0, 13, True), 2: ("L2", 5, 18, True), 3: ("L1", 0, 13, False), 6: ("L2", 0, 14, True), 7: ("L2", 5, 16, True)}


def test_checks_name_what_is_broken(spark):
    from weftline.operators import checks

    rows = [("a", "text", 0, 4), (None, "x", 0, 1), ("b", None, 0, 1), ("c", "xy", 3, 4)]
    got = {r.line_id: r.problems for r in checks.broken_lines(spark.createDataFrame(rows, "line_id string, text string, char_start int, char_end int")).collect()}
    assert got == {None: "no_id", "b": "no_text;offsets", "c": "offsets"}


def test_repair(spark):
    rows = [("a b a", "a", -1, -1, ""), ("a b a", "a", 4, 5, ""), ("a b a", "a", 3, 9, ""), ("a b a", "a", -1, -1, "b a"), ("x", "a", 0, 1, "")]
    df = spark.createDataFrame(rows, "t string, s string, a int, b int, e string")
    c = F.col
    assert [r[0] for r in df.select(grounding.repair_offset(c("t"), c("s"), c("a"), c("b"), c("e"))).collect()] == [0, 4, 4, 0, None]
