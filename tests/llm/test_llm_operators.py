"""The operators beside brute force, and on the awkward inputs: nulls, blanks, long texts, ties, copies, empty tables, clashing names."""

import math
import random
import re
import unicodedata
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from weftline.llm import canonical, consistent_form, cooccurrence, distinctive_terms, encoding, markup, mixing, packing, page_difference, repeated_lines, term_frequency, tokens

LONG = "Größe und Maß – façade. " * 20_000


# --- 1 -------------------------------------------------------------------------------------------------------------------


def brute_form(text):
    if text is None:
        return None
    plain = "".join("-" if c == "\u2011" else unicodedata.normalize("NFKC", c) for c in text)
    plain = "".join(" " if unicodedata.category(c) == "Zs" else c for c in plain if unicodedata.category(c) != "Cf")
    plain = unicodedata.normalize("NFC", plain)
    theirs, latin = consistent_form.LOOK_ALIKES["Cyrillic"]
    to = dict(zip(theirs, latin))

    def word(m):
        w = m[0]
        if not (any("LATIN" in unicodedata.name(c, "") for c in w) and any(c in to for c in w)):
            return w
        return "".join(to.get(c, c) for c in w)

    return unicodedata.normalize("NFC", re.sub(r"[^\W\d_]+", word, plain))


def test_consistent_form(spark):
    values = ["plain", "", None, "ｆｕｌｌ ｗｉｄｔｈ", "cafe\u0301", "zero\u200bwidth", "a\u00a0b", "Rоutіng", "Грамотная речь", "Γνώση δεξιοτήτων", "“quote” – €5 •", "o\ufb03ce ½", "Walk\u2011in", LONG, "cafe\u0301" * 30_000]
    df = spark.createDataFrame([(i, v, "x") for i, v in enumerate(values)], "k int, value string, consistent string")
    got = {r.k: r.consistent for r in consistent_form.consistent_form(df, "value").collect()}
    assert [got[i] for i in range(len(values))] == [brute_form(v) for v in values]
    again = spark.createDataFrame([(v,) for v in got.values()], "value string")
    assert [r.consistent for r in consistent_form.consistent_form(again, "value").collect()] == list(got.values())


def test_words_of_another_script_with_latin_letters(spark):
    df = spark.createDataFrame([("Сoюз",), ("союз",), ("Сoo",)], "v string")  # o is Latin in the first and the last
    assert [r.consistent for r in consistent_form.consistent_form(df, "v").collect()] == ["Союз", "союз", "Coo"]


def test_inconsistent_values(spark):
    d = spark.createDataFrame([(1, "a\u200bb"), (1, "a\u200bb"), (2, None), (3, "ok"), (None, "x\u00a0y")], "job_index bigint, description_raw string")
    m = spark.createDataFrame([("m1", "ｘ", 1), ("m2", "", 2)], "mention_id string, skill_span string, value int")
    assert {tuple(r) for r in consistent_form.inconsistent(d, m).collect()} == {("description_raw", "1"), ("description_raw", None), ("skill_span", "m1")}
    assert consistent_form.inconsistent(d.limit(0), m.limit(0)).count() == 0


# --- 2 -------------------------------------------------------------------------------------------------------------------


def osa(a, b):
    """Optimal string alignment distance."""
    d = [[max(i, j) if not min(i, j) else 0 for j in range(len(b) + 1)] for i in range(len(a) + 1)]
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            d[i][j] = min(d[i - 1][j] + 1, d[i][j - 1] + 1, d[i - 1][j - 1] + (a[i - 1] != b[j - 1]))
            if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
                d[i][j] = min(d[i][j], d[i - 2][j - 2] + 1)
    return d[-1][-1]


def test_automaton_finds_what_the_distance_says():
    rng = random.Random(5)
    entries = [(i, ["".join(rng.choice("abc ") for _ in range(rng.randint(3, 16))).strip() or "abcabc"]) for i in range(60)]
    trie = canonical.Trie(entries)
    windows = [" ".join(canonical.words_of("".join(rng.choice("abcd ") for _ in range(rng.randint(1, 18))))) for _ in range(300)]
    windows = sorted({w for w in windows if w})
    got = {}
    for w, ref, errors, _ in trie.search(windows):
        got[w, ref] = min(errors, got.get((w, ref), 9))
    want = {}
    for w, text in enumerate(windows):
        for ref, names in entries:
            best = [e for path, limit in canonical.paths(names).items() if (e := osa(text, path)) <= limit]
            if best:
                want[w, ref] = min(best)
    assert got == want and got


def test_canonical_values(spark):
    skills = spark.createDataFrame([(1, "Invoice matching", ["IM9"]), (2, "Teamwork", None), (3, "Cold-chain packing", [])], "ref_id bigint, canonical_skill string, aliases array<string>")
    titles = spark.createDataFrame([(1001, "Data Engineer"), (1002, "Registered Nurse")], "ref_id bigint, normalized_title string")
    values = {"a": "matching, invoice", "b": "invocie matchign", "c": "strong TEAMWORK - 2 yrs", "d": "col-dchain packing", "e": "IM9", "f": "Invoice songs", "g": None, "h": "  ", "i": "Teamwork", "j": "word " * 30_000 + "teamwork", "k": "x" * 5000}
    m = spark.createDataFrame([(k, v, "clash", 1) for k, v in values.items()] * 2, "mention_id string, normalized_candidate string, value string, ref_id int")
    jobs = spark.createDataFrame([(1, "Sr. Data Eng. (Remote) [Ref 7]"), (2, "Lead Reg'd Nurse"), (3, "Data Sculptor"), (4, None)], "job_index bigint, title_raw string")
    c = canonical.canonical_values(m, jobs, skills, titles)
    got = {(r.field, r.record_id): r.ref_id for r in canonical.mapped(c, skills, titles).collect()}
    n = "normalized_candidate"
    assert got == {(n, "a"): 1, (n, "b"): 1, (n, "c"): 2, (n, "d"): 3, (n, "e"): 1, (n, "f"): -1, (n, "j"): 2, (n, "k"): -1, ("title_raw", "1"): 1001, ("title_raw", "2"): 1002, ("title_raw", "3"): -1}
    assert canonical.unmatched_report(c).count() == 3
    assert canonical.canonical_values(m.limit(0), jobs.limit(0), skills, titles).count() == 0
    none = canonical.canonical_values(m, jobs, skills.limit(0), titles.limit(0))
    assert {r.ref_id for r in none.collect()} == {-1}


def test_shards_and_blocks_change_nothing(spark):
    skills = spark.createDataFrame([(i, f"skill number {chr(97 + i) * 6}", []) for i in range(9)], "ref_id bigint, canonical_skill string, aliases array<string>")
    entries = canonical.entries_of(skills, "s", "canonical_skill", "aliases")
    values = spark.createDataFrame([("s", f"skill number {chr(97 + i) * 6}") for i in range(9)] + [("t", "skill number aaaaaa")], "list string, value string")
    for kw in ({}, {"shard_entries": 2, "block_values": 3}):
        got = {(r.list, r.value): r.ref_id for r in canonical.match_values(values, entries, **kw).collect()}
        assert got == {("s", f"skill number {chr(97 + i) * 6}"): i for i in range(9)} | {("t", "skill number aaaaaa"): -1}


def test_entries_of_any_length_are_found(spark):
    long = "senior principal " + "interdepartmental " * 3 + "reconciliation and settlement officer"
    assert len(long) > 85
    skills = spark.createDataFrame([(1, long, None), (2, "abbreviated thing", None), (None, "no id", None), (3, None, None)], "ref_id bigint, canonical_skill string, aliases array<string>")
    typed = {"exact": long, "slips": "the " + long.replace("settlement", "setlement").replace("principal", "principla").replace("officer", "oficer") + ", part time", "no": long[:60], "short": "abbr. thing", "": "thing"}
    values = spark.createDataFrame([("s", v) for v in typed.values()], "list string, value string")
    entries = canonical.entries_of(skills, "s", "canonical_skill", "aliases")
    got = {r.value: r.ref_id for r in canonical.match_values(values, entries).collect()}
    assert [got[v] for v in typed.values()] == [1, 1, -1, 2, -1]
    assert {r.value: r.ref_id for r in canonical.match_values(values, entries, abbreviations={"abbreviated": ("abd",)}).collect()}["abbr. thing"] == 2  # a prefix of three letters needs no table
    assert [canonical.allowed(n) for n in (4, 5, 6, 7, 24, 25, 48, 49)] == [0, 1, 1, 2, 2, 3, 3, 4]
    trie = canonical.Trie([(1, ["x" * 70]), (2, ["y" * 20])])
    assert {(w, r, e) for w, r, e, _ in trie.search(["x" * 70, "x" * 67, "y" * 18, "x" * 61, "yx" + "x" * 69])} == {(0, 1, 0), (1, 1, 3), (2, 2, 2), (4, 1, 1)}


# --- 3 -------------------------------------------------------------------------------------------------------------------


def line_table(spark):
    notice, body = "All rights reserved by this site here", "We look for people who like long walks"
    rows = []
    for p in range(30):
        rows.append((f"n{p}", p, "big", notice.upper() if p % 2 else notice + "!", "x", 1))
        rows.append((f"u{p}", p, "big", f"A line of its own for posting {chr(97 + p % 26)}{chr(97 + p // 26)}", "x", 1))
    for p in range(30, 34):  # one article under four ids
        rows += [(f"a{p}", p, "big", body, "x", 1), (f"b{p}", p, "big", "And it ends with this very line", "x", 1)]
    rows += [("s1", 40, "small", notice, "x", 1), ("s2", 41, "small", notice, "x", 1), ("null1", 50, None, notice, "x", 1), ("null2", 51, "big", None, "x", 1), ("null3", None, "big", notice, "x", 1), ("short", 52, "big", "Too few words", "x", 1), ("long", 53, "big", LONG, "x", 1)]
    return spark.createDataFrame(rows + rows[:20], "line_id string, job_index bigint, source string, text string, h1 string, mark int")


def test_repeated_lines(spark):
    lines = line_table(spark)
    by_posting = repeated_lines.repeated_lines(lines, cluster="posting")
    ids = {r.line_id for r in repeated_lines.repeated_line_rows(lines, by_posting).collect()}
    assert ids == {f"n{p}" for p in range(30)} | {f"{x}{p}" for x in "ab" for p in range(30, 34)} | {"null3"}
    dates = spark.createDataFrame([(p, f"2024-01-{p % 28 + 1:02d} 10:00:00") for p in range(60)], "job_index bigint, posted_at string").withColumn("posted_at", F.col("posted_at").cast("timestamp"))
    by_text = repeated_lines.repeated_lines(lines, dates, cluster="text", min_days=2)
    rows = {r.n_clusters: r for r in by_text.collect()}
    assert set(rows) == {30} and rows[30].n_days == 28  # the republished article is one cluster, no notice
    kept = {r.line_id for r in repeated_lines.without_repeated(lines, by_posting).collect()}
    assert kept == {r.line_id for r in lines.collect()} - ids
    assert repeated_lines.mark_lines(lines, by_posting).columns == [*lines.columns, "repeated"]
    assert repeated_lines.repeated_lines(lines.limit(0)).count() == 0


def test_lines_are_counted_from_clusters_alone(spark, monkeypatch):
    lines = line_table(spark)
    clusters = repeated_lines.document_clusters(lines)
    assert sorted(r.n_postings for r in clusters.where("source = 'big'").collect()) == [1] * 32 + [4]  # one row for the article
    monkeypatch.setattr(repeated_lines, "document_clusters", lambda *a: clusters.where("n_postings <> 4"))
    ids = {r.line_id for r in repeated_lines.repeated_line_rows(lines, repeated_lines.repeated_lines(lines, by="postings")).collect()}
    assert ids == {f"n{p}" for p in range(30)} | {"null3"}  # without its cluster the article is nowhere
    monkeypatch.undo()
    ids = {r.line_id for r in repeated_lines.repeated_line_rows(lines, repeated_lines.repeated_lines(lines, by="postings")).collect()}
    assert ids == {f"n{p}" for p in range(30)} | {f"{x}{p}" for x in "ab" for p in range(30, 34)} | {"null3"}


# --- 4 -------------------------------------------------------------------------------------------------------------------

MARKED = {
    "<h2>Role</h2><ul><li>One</li><li>Two</li></ul>": "Role\n• One\n• Two",
    "<ol><li>A<li>B</ol>": "1. A\n2. B",
    "&lt;p&gt;Hi &amp; bye&lt;/p&gt;": "Hi & bye",
    "a<br>b&nbsp;c": "a\nb c",
    "x <!-- gone --> y": "x  y",
    "<pre><code>if a &lt; b:\n    c()</code></pre>": "if a < b:\n    c()",
    "## Role\n* **Bold** item": "Role\n* Bold item",
    "Role\n----\ntext": "Role\ntext",
    "see [this](/x) and `code_1`": "see this and code_1",
    "```sql\nSELECT *\n  FROM t\n```": "SELECT *\n  FROM t",
    "| a | b |\n|---|---|\n| 1 | 2 |": "| a | b |\n| 1 | 2 |",
    "> quoted text": "quoted text",
    "== Role ==\n** [[a|b]] and '''c'''": "Role\n• b and c",
    "x {{T|y=1}}<ref>n</ref> z": "x 1 z",
    "\\section*{Role} \\\\\n\\begin{itemize}\n\\item \\textbf{One} \\& two\n\\end{itemize}": "Role\n\n• One & two",
    "mean $c = \\sqrt{a}$ here": "mean c = \\sqrt{a} here",
}
PLAIN = ["Pay is $16,000 - $26,500", "Rated #6 locally", "C# or F# is fine", "R&D and Q&A days", "use snake_case_names here", "* bullet\n- dash\n1. one\n+ plus", "9 * 4 hours * 2", "x < 5 and y > 3", "Travel is < 2% and > 1 per shift", "Cost code {A-8} and [1]", "| Adjustments on request", "3/4\" spanners & a torch", "a --- b", "", "AT&T; and so on"]


@pytest.mark.parametrize("text", MARKED)
def test_markup_is_read(text):
    clean, kinds, blocks = markup.read_markup(text)
    assert kinds and blocks
    assert [x.strip() for x in clean.split("\n") if x.strip()] == [x.strip() for x in MARKED[text].split("\n") if x.strip()]
    assert re.search(markup.SUSPECT, text)
    if "sqrt" not in text:
        assert markup.read_markup(clean)[1] == []


@pytest.mark.parametrize("text", PLAIN)
def test_plain_text_is_left(text):
    assert markup.read_markup(text)[:2] == (text, [])


ONLY_MARK = ["see [https://x.y here] now", "$$\na = b + c\n$$", "<!DOCTYPE html>\ntext", "<?xml version='1.0'?>\ntext", "a\n#* item", "a |\n---|\n1 |"]


def test_the_filter_lets_every_mark_through(spark):
    assert all(markup.read_markup(t)[1] for t in ONLY_MARK)
    df = spark.createDataFrame(list(enumerate([*ONLY_MARK, *PLAIN])), "job_index bigint, description_raw string")
    assert {r.job_index for r in markup.marked_up(df).collect()} == set(range(len(ONLY_MARK)))


@pytest.mark.parametrize("text, want", [("a" + "{{x|" * 12 + "}}" * 12 + "b", "ab"), ("\\textbf{" * 12 + "a" + "}" * 12, "a"), ("a &" + "amp;" * 6 + " b", "a & b"), ("**" + "~~_" * 6 + "a" + "_~~" * 6 + "**", None)])
def test_markup_of_any_depth_is_read(text, want):
    clean, kinds, _ = markup.read_markup(text)
    assert kinds and (want is None or clean == want) and markup.read_markup(clean)[:2] == (clean, [])


def test_marked_up(spark):
    rows = [(1, "<b>x</b>", "c"), (1, "<b>x</b>", "c"), (2, None, "c"), (3, "", "c"), (4, LONG, "c"), (5, LONG + "<p>end</p>", "c"), (None, "&amp;", "c")]
    df = spark.createDataFrame(rows, "job_index bigint, description_raw string, clean_text_kinds string")
    assert {r.job_index for r in markup.marked_up(df).collect()} == {1, 5, None}
    assert markup.marked_up(df.limit(0)).count() == 0
    got = markup.clean_markup(df, "description_raw")
    assert got.count() == len(rows) and set(df.columns) <= set(got.columns)
    kinds = {b.kind for b in markup.clean_markup(spark.createDataFrame([("# A\n- b\n```\nc\n```\n$x^2$",)], "t string"), "t").first().clean_text_blocks}
    assert kinds == {"heading", "list_item", "code", "formula"}


# --- 5 -------------------------------------------------------------------------------------------------------------------


def test_term_frequency(spark):
    rng = random.Random(2)
    rows = [(f"m{i}", rng.randint(0, 40) if i % 3 else 7, "Hot" if i % 3 == 0 else rng.choice(["hot ", " rare", "b", "", None, "É", "c" * 5000]), None if i % 5 == 0 else "span", "clash") for i in range(900)]
    rows += rows[:100] + [("n", None, "hot", "span", "clash")]
    df = spark.createDataFrame(rows, "mention_id string, job_index bigint, normalized_candidate string, skill_span string, term string").repartition(5)
    n, records = Counter(), defaultdict(set)
    for _, job, a, b, _ in {r[:4] + ("",) for r in rows}:
        for field, v in (("normalized_candidate", a), ("skill_span", b)):
            t = (v or "").strip(" ").lower()
            if t and job is not None:
                n[field, t] += 1
                records[field, t].add(job)
    got = {(r.field, r.term): (r.n_rows, r.n_records) for r in term_frequency.mention_terms(df).collect()}
    assert got == {k: (n[k], len(records[k])) for k in n}
    total = len({r[1] for r in rows if r[1] is not None})
    marks = {(r.field, r.term): r.mark for r in term_frequency.mention_terms(df).collect()}
    assert all(marks[k] == ("rare" if len(v) < 3 else "common" if len(v) > 0.08 * total else None) for k, v in records.items())
    assert term_frequency.mention_terms(df.limit(0)).count() == 0


# --- 6 -------------------------------------------------------------------------------------------------------------------


@pytest.mark.parametrize("block", [4, 128])
def test_cooccurrence(spark, block):
    rng = random.Random(4)
    rows = [(f"b{i % 30}", rng.choice("ABCDEFGH"), "x") for i in range(400)] + [("big", f"item {i % 40}", "x") for i in range(120)] + [(f"c{j}", f"item {i}", "x") for j in range(6) for i in (1, 2, 3)]
    rows += [(None, "A", "x"), ("b1", None, "x"), ("b1", " ", "x")] + rows[:50]
    df = spark.createDataFrame(rows, "job_id string, normalized_candidate string, basket string").repartition(4)
    baskets = defaultdict(set)
    for b, i, _ in rows:
        if b is not None and (i or "").strip(" "):
            baskets[b].add(i.strip(" ").lower())
    both, single = Counter(), Counter()
    for items in baskets.values():
        single.update(items)
        both.update((a, b) for a in items for b in items if a < b)
    want = {(a, b): (single[a], single[b], c) for (a, b), c in both.items() if c >= 5}
    got = {(r.a, r.b): (r.n_a, r.n_b, r.n_both) for r in cooccurrence.cooccurrence(df, "job_id", "normalized_candidate", block=block).collect()}
    assert got == want and any(a.startswith("item") for a, _ in want)
    assert cooccurrence.cooccurrence(df.limit(0), "job_id", "normalized_candidate").count() == 0


# --- 7 -------------------------------------------------------------------------------------------------------------------


def test_distinctive_terms(spark):
    rows = [("f", 1, "a", 3), ("f", 1, "b", 1), ("f", 2, "a", 1), ("f", 2, "c", 5), ("f", 3, "d", 1), ("g", 1, "a", 2)]
    df = spark.createDataFrame(rows, "field string, record bigint, term string, y bigint")
    got = {(r.field, r.record, r.term): r for r in distinctive_terms.term_scores(df, 10.0).collect()}
    f = [r for r in rows if r[0] == "f"]
    all_, c, n = sum(r[3] for r in f), sum(r[3] for r in f if r[2] == "a"), sum(r[3] for r in f if r[1] == 1)
    a = c / all_ * 10
    inside, outside = math.log((3 + a) / max(n + 10 - 3 - a, 1)), math.log((c - 3 + a) / max(all_ - n + 10 - (c - 3) - a, 1))
    assert got["f", 1, "a"].z == pytest.approx((inside - outside) / math.sqrt(1 / (3 + a) + 1 / (c - 3 + a)))
    assert (got["f", 1, "a"].n_records, got["f", 3, "d"].n_record) == (2, 1)
    assert len(got) == len(rows) and all(r.z == r.z for r in got.values())


def test_posting_terms(spark):
    m = [(f"m{j}{i}", j, "Rare Skill", "z") for j in (1, 2) for i in range(3)] + [(f"o{j}", j, "usual", "z") for j in range(9)] + [("x", None, "usual", "z"), (None, 1, "usual", "z"), ("y", 3, None, "z")]
    mentions = spark.createDataFrame(m + m[:4], "mention_id string, job_index bigint, normalized_candidate string, record string")
    jobs = spark.createDataFrame([(1, "Zeppelin pilot", 0.0), (2, "zeppelin PILOT II", 0.0), (3, None, 0.0), (4, " ", 0.0), (5, "Über", 0.0)], "job_index bigint, title_raw string, z double")
    got = {tuple(r) for r in distinctive_terms.distinctive(distinctive_terms.posting_terms(mentions, jobs)).collect()}
    assert got == {("normalized_candidate", j, "rare skill") for j in (1, 2)} | {("title_raw", j, w) for j in (1, 2) for w in ("zeppelin", "pilot")}
    assert distinctive_terms.posting_terms(mentions.limit(0), jobs.limit(0)).count() == 0


def test_a_low_score_loses_no_case(spark):
    """A term that a large posting has three times and another one has thousands of times."""
    m = [(f"a{i}", 1, "t") for i in range(3)] + [(f"b{i}", 1, f"u{i}") for i in range(3000)] + [(f"c{i}", 2, "t") for i in range(3000)]
    mentions = spark.createDataFrame(m, "mention_id string, job_index bigint, normalized_candidate string")
    scores = distinctive_terms.posting_terms(mentions, spark.createDataFrame([], "job_index bigint, title_raw string"))
    assert scores.where("record = 1 and term = 't'").first().z < -10
    assert {tuple(r) for r in distinctive_terms.distinctive(scores).collect()} == {("normalized_candidate", j, "t") for j in (1, 2)}


@pytest.mark.parametrize("prior_size", [0.5, 20.0, 500.0])
def test_the_score_selects_and_loses_no_case(spark, prior_size):
    rng = random.Random(7)
    m = [(j, f"t{j // rng.choice([2, 3])}") for j in range(60) for _ in range(rng.choice([1, 8, 8, 60]))] + [(j, "everywhere") for j in range(500)] + [(j, f"own {j}") for j in range(500) for _ in range(5)]
    titles = [(j, f"clerk {rng.choice(['north', 'south'])} word{chr(97 + j % 26)}{chr(97 + j // 52)}") for j in range(500)]
    y = Counter(m)
    n = Counter(t for _, t in y)
    words = Counter((j, w) for j, t in titles for w in set(t.split()))
    n_words = Counter(w for _, w in words)
    want = {("normalized_candidate", j, t) for (j, t), k in y.items() if k >= 3 and 2 <= n[t] <= 5} | {("title_raw", j, w) for j, w in words if len(w) >= 4 and 2 <= n_words[w] <= 5}
    mentions = spark.createDataFrame([(f"m{i}", *r) for i, r in enumerate(m)], "mention_id string, job_index bigint, normalized_candidate string")
    scores = distinctive_terms.posting_terms(mentions, spark.createDataFrame(titles, "job_index bigint, title_raw string"), prior_size)
    assert {tuple(r) for r in distinctive_terms.distinctive(scores).collect()} == want and len(want) > 10
    selected = Counter(r.term for r in distinctive_terms.stressed_enough(scores).collect())
    assert (selected["clerk"] == 500) if prior_size < 1 else (selected["clerk"] == 0 and selected["own 1"] == 1)  # by its score alone, before any count


# --- 8 and 9 ---------------------------------------------------------------------------------------------------------------


def texts(spark):
    rng = random.Random(8)
    rows = [(i, " ".join(rng.choice(["word", "another", "größe", "x1"]) for _ in range(rng.choice([0, 3, 40, 150, 900]))), "s" + str(min(i % 7, 3)), "reply" if i % 4 == 0 else "note", 1) for i in range(300)]
    rows += [(1000, None, "s1", None, 1), (1001, LONG, "s2", "reply", 1), (1002, "lost", None, "note", 1), (None, "no id", "s1", "note", 1), (5, "second text of five", "s1", "note", 1)]
    return spark.createDataFrame(rows, "doc_id bigint, text string, source string, kind string, shard int")


def test_token_counts(spark):
    enc = tokens.encoder(tokens.TOKENIZER)
    got = tokens.with_token_counts(texts(spark)).collect()
    by_id = {r.doc_id: r.n_tokens for r in got}
    assert by_id[1001] == len(enc.encode_ordinary(LONG)) and by_id[1000] == 0 and len(got) == 305


@pytest.mark.parametrize("shard_items", [50, 20_000])
def test_packing(spark, shard_items):
    docs, caps = texts(spark), spark.createDataFrame([("s", 64), ("l", 1024)], "container string, capacity_tokens int")
    size = Counter()
    for r in tokens.with_token_counts(docs).collect():
        size[r.doc_id] += r.n_tokens
    rows = packing.pack_documents(docs, caps, shard_items=shard_items).collect()
    for name, cap in (("s", 64), ("l", 1024)):
        own = [r for r in rows if r.container == name]
        placed, bins = Counter(), defaultdict(list)
        for r in own:
            placed[r.doc_id] += r.n_tokens
            assert r.n_tokens <= cap and (r.bin_id is None) == (r.n_tokens == 0)
            if r.bin_id:
                bins[r.bin_id].append(r)
        assert placed == size
        for b in bins.values():
            assert sum(r.n_tokens for r in b) <= cap and len(b) <= max(1, cap // 16)
            assert sum(r.loss_tokens > 0 for r in b) <= 1 or sum(r.loss_tokens for r in b) <= int(cap * 0.75)
        pieces = Counter(r.doc_id for r in own if r.doc_id not in (5, None))
        assert all((n > 1) == (size[d] > cap) for d, n in pieces.items())
    if shard_items > 300:
        used = {r.container: r.unused_share for r in packing.usage(packing.pack_documents(docs, caps)).collect()}
        assert used["l"] < 0.1
    assert packing.pack_documents(docs.limit(0), caps).count() == 0
    with pytest.raises(ValueError):
        packing.pack_documents(docs, spark.createDataFrame([("z", 0)], caps.schema))


def test_mixing(spark):
    docs = texts(spark)
    targets = spark.createDataFrame([("s0", 0.5, 2), ("s1", 0.3, 3), ("s2", 0.15, 4), ("none", 0.05, 9), ("s3", None, None)], "source string, target_share double, max_repeats int")
    selection, shares = mixing.mix(docs, targets)
    rows, report = selection.collect(), {r.source: r for r in shares.collect()}
    cap = {"s0": 2, "s1": 3, "s2": 4}
    assert all(1 <= r.copies <= cap[r.source] for r in rows) and len({r.doc_id for r in rows}) == len(rows)
    assert report["s2"].status == "short"  # its one very long document doesn't fit the gap
    for s, r in report.items():
        got = sum(x.n_tokens * x.copies for x in rows if x.source == s)
        assert r.selected_tokens == got <= max(r.target_tokens, 0)
        if r.status == "met" and r.available_tokens and r.target_tokens:
            assert got >= 0.9 * r.target_tokens
        assert max([x.copies for x in rows if x.source == s], default=r.epochs) - min([x.copies for x in rows if x.source == s], default=r.epochs) <= 1
    assert report["none"].status == "empty" and sum(r.actual_share for r in report.values()) == pytest.approx(1)
    again = mixing.mix(docs.repartition(5), targets)[0].collect()
    assert sorted(map(tuple, again)) == sorted(map(tuple, rows))
    assert mixing.mix(docs.limit(0), targets)[0].count() == 0


# --- 10 ----------------------------------------------------------------------------------------------------------------------

CORPUS = [
    "Für die Prüfung der Geräte suchen wir Kräfte mit Übung",
    "Hledáme člověka, který zvládne třídění zásilek ve špičce",
    "Требуется сотрудник, умеющий вести складской учёт",
    "Être à l’aise avec la mécanique légère reste un atout décisif",
    "A crêpe stand, fête night – “two references” for £5",
]
WRONG = [("utf-8", "latin-1"), ("utf-8", "cp1252"), ("utf-8", "mac_roman"), ("utf-8", "cp437"), ("utf-8", "cp1251"), ("cp1250", "cp1252"), ("cp1251", "koi8-r")]


def misread(text, right, wrong):
    out = []
    for b in text.encode(right):
        try:
            out.append(bytes([b]).decode(wrong))
        except UnicodeError:
            out.append(chr(b))
    return "".join(out)


def test_encodings_are_undone(spark):
    docs, want = [], {}
    for i in range(200):
        docs.append((i, CORPUS[i % 5], "v"))
    for right, wrong in WRONG:
        for text in CORPUS:
            try:
                bad = misread(text, right, wrong)
            except UnicodeError:
                continue
            if bad != text and not (right == "cp1250" and "č" not in text) and not (right == "cp1251" and "у" not in text):
                want[len(docs)] = text
                docs.append((len(docs), bad, "v"))
    want[len(docs)] = CORPUS[0]
    docs.append((len(docs), misread(misread(CORPUS[0], "utf-8", "cp1252"), "utf-8", "cp1252"), "v"))
    want[len(docs)] = CORPUS[0]
    docs.append((len(docs), CORPUS[0].encode("latin-1").decode("utf-8", "replace"), "v"))
    lost = len(docs)
    docs += [(lost, "an unknown w�rd", "v"), (lost + 1, None, "v"), (lost + 2, "", "v"), (lost + 3, "├── intake\n│   └── x ≥ θ", "v"), (lost + 4, "plain " * 50_000 + "Ñandú", "v"), (None, "fÃ¼r", "v")]
    df = spark.createDataFrame(docs + docs[200:203], "doc_id bigint, text string, version string")
    assert {r.doc_id for r in encoding.garbled(df).collect()} == set(want) | {lost}
    got = {r.doc_id: r for r in encoding.restore(df).collect()}
    same = [i for i in want if got[i].restored_text == want[i]]
    print([(want[i], got[i].restored_text) for i in want if i not in same])
    assert len(same) >= len(want) - 1 and not got[lost].complete
    assert encoding.garbled(df.limit(0)).count() == 0


def test_lattice_and_path():
    any_ = encoding.ANY
    assert encoding.from_lattice([0xC3, frozenset({0xA9}), 0x72], "utf-8") == ("ér", [])
    assert encoding.from_lattice([0xD0, encoding.left_open("cp1252")], "utf-8") == ("�", ["ЁЍЏАН"])
    assert encoding.from_lattice([any_, 0xB0], "utf-8")[1][0].startswith("°ðİ"[:1]) and encoding.from_lattice([any_, 0x72], "utf-8") == ("�r", [""])
    assert encoding.from_lattice([encoding.left_open("cp1252"), 0xB0], "utf-8") is None
    assert encoding.left_open("latin-1") == any_ and encoding.left_open("cp1251") == {0x98}
    assert encoding.from_lattice([0xC3, 0x28], "utf-8") is None
    assert encoding.viterbi([{"x": 9.0}, {"x": -0.5}, {"x": 9.0}]) == ["x", "x", "x"]
    assert encoding.viterbi([{"x": 1.0}]) == [""]
    assert encoding.viterbi([]) == []


def test_copies_do_not_speak_for_a_garbled_text(spark):
    texts = {"cp1251": "Опытный программист ищет работу", "cp1250": "řízení výroby a účetnictví"}
    docs = []
    for i in range(6):
        docs += [(len(docs), f"{t} {i}") for t in [*texts.values(), "nový překlad"]]
    bad = {}
    for right, t in texts.items():
        for _ in range(60):
            bad[len(docs)] = t
            docs.append((len(docs), misread(t, right, "cp1252")))
    bad[len(docs)] = "the word překlad alone"
    docs.append((len(docs), misread("the word překlad alone", "cp1250", "cp1252")))
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    assert {r.doc_id for r in encoding.garbled(df).collect()} == set(bad)
    assert {r.doc_id: r.restored_text for r in encoding.restore(df).collect()} == bad


def test_lost_characters_come_back_right_or_stay(spark):
    corpus = ["Наша система управления и разработка, важная работа для команды.", "Система управления ждёт. Разработка идёт.", "職務経歴書を提出してください。", "Für die Übung braucht man Größe und Gefühl.", "L’été, la crème et la forêt."]
    bad = {100: "Новая разработ�а и р�б�ота тут", 101: "職務経�書", 102: "F�r die �bung", 103: "�� ��� ���", 104: "Разработ�а — СИСТ�МА", 105: "tr�s cr�me", 106: "�Sabe", 107: "f�� x�"}
    want = {100: "Новая разработка и р�б�ота тут", 101: "職務経�書", 102: "Für die Übung", 103: "�� ��� ���", 104: "Разработка — СИСТЕМА", 105: "tr�s crème", 106: "�Sabe", 107: "f�� x�"}
    rows = [(i, f"{t} ({i})") for i, t in enumerate(corpus * 4)] + list(bad.items())
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {r.doc_id: r for r in encoding.restore(df).collect()}
    assert {i: r.restored_text for i, r in got.items()} == want
    assert {i for i, r in got.items() if r.complete} == {102, 104}


def test_a_lattice_has_the_bytes_that_an_encoding_leaves_open(spark):
    text = "Надёжная Новая Авария и Няня"
    bad = text.encode("utf-8").decode("cp1252", "replace")
    assert bad.count("�") > 4
    rows = [(i, f"{text} {i}") for i in range(5)] + [(9, bad)]
    got = encoding.restore(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert [(r.doc_id, r.restored_text, r.complete) for r in got] == [(9, text, True)]


def test_path_grows_with_the_steps():
    import random
    import time

    rng = random.Random(2)
    steps = [{c: rng.uniform(-2, 4) for c in rng.sample("abcdefgh", 4)} for _ in range(20_000)]
    began = time.time()
    path = encoding.viterbi(steps)
    assert len(path) == len(steps) and time.time() - began < 5

    def worth(p, s):
        cost = lambda a, b: 0.0 if a == b else encoding.LEAVE if b == "" else encoding.ENTER if a == "" else encoding.ENTER + encoding.LEAVE
        return sum(g.get(c, 0.0) for g, c in zip(s, p)) - sum(cost(a, b) for a, b in zip(["", *p], p))

    import itertools

    short = steps[:5]
    best = max(worth(p, short) for p in itertools.product(*[["", *s] for s in short]))
    assert worth(encoding.viterbi(short), short) == pytest.approx(best)


# --- 4, the method named ---------------------------------------------------------------------------------------------------


def test_pages_lose_what_their_neighbours_have_too(spark):
    menu = "Home | Jobs | About"
    foot = "© Example Ltd\nShare this page"
    page = lambda body: f"{menu}\n\n{body}\n{foot}"
    rows = [("a", "/jobs/1", page("Painter\nApply now"), "x"), ("a", "/jobs/2", page("Baker\nApply now"), "x"), ("a", "/news/1", page("Opening"), "x"), ("b", "/jobs/1", page("Painter"), "x"), (None, "/", page("n"), "x"), ("a", "/none", None, "x"), ("a", None, "", "x"), ("a", "/jobs/3", page("Baker\nApply now"), "x")]
    df = spark.createDataFrame(rows + rows[:1], "host string, path string, text string, difference string")
    got = page_difference.page_differences(df).collect()
    assert len(got) == len(rows) + 1 and df.columns == [c for c in got[0].__fields__]
    by = {(r.host, r.path): r.difference for r in got}
    assert by["a", "/jobs/1"].split() == ["Painter"] and by["a", "/jobs/2"].split() == ["Baker"] == by["a", "/jobs/3"].split()
    assert by["a", "/news/1"].split() == ["Opening"]
    assert by["b", "/jobs/1"] == page("Painter") and by[None, "/"] == page("n") and by["a", "/none"] is None and by["a", None] == ""
    assert page_difference.page_differences(df.limit(0)).count() == 0


def test_common_lines_are_a_longest_common_subsequence():
    rng = random.Random(8)

    def length(a, b):
        grid = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                grid[i + 1][j + 1] = grid[i][j] + 1 if x == y else max(grid[i][j + 1], grid[i + 1][j])
        return grid[-1][-1]

    for _ in range(500):
        a, b = ([rng.choice("abcd") for _ in range(rng.randint(0, 14))] for _ in "ab")
        places = sorted(page_difference.common_lines(a, b))
        rest = iter(b)
        assert len(places) == length(a, b) and all(a[i] in rest for i in places)
    many = [str(rng.random()) for _ in range(3000)]
    assert len(page_difference.common_lines(many, many[::2])) == 1500


def test_templates_and_names():
    assert markup.read_markup("Ask {{name}} or {{lang|de|Amt}} now, '''soon'''")[0] == "Ask name or de Amt now, soon"
    assert markup.read_markup("call __init__ or __main__ first") == ("call __init__ or __main__ first", [], markup.read_markup("call __init__ or __main__ first")[2])
    assert markup.read_markup("this is __urgent__ work")[0] == "this is urgent work"


def test_invisible_characters_beyond_format(spark):
    df = spark.createDataFrame([("a͏b",), ("xㅤy",), ("ᅟz",), ("qﾠ",)], "v string")
    assert [r.consistent for r in consistent_form.consistent_form(df, "v").collect()] == ["ab", "xy", "z", "q"]
