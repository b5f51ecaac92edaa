"""Column expressions over posting text: normalization, headings, section and boilerplate labels, quality.

Everything here stays in the JVM. Patterns carry ``(?iUd)``: case-insensitive, Unicode classes, line feeds as the only line end.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Input keys in order of preference.
TITLE_KEYS = ("JobTitle", "jobTitle", "job_title", "title_raw", "title_norm", "Title", "title", "position", "PositionTitle")
DESCRIPTION_KEYS = ("JobDescription", "jobDescription", "description_raw", "Description", "description", "JobDesc", "jobDesc", "posting", "jobPosting", "job_description")

# Headings, whole-line, first match wins; the legal one is a prefix.
SECTION_LINES = (
    ("requirements", r"(requirements?|required\s+qualifications?|minimum\s+qualifications?)\s*:?\s*$"),
    ("preferred", r"(preferred\s+qualifications?|nice\s+to\s+have|bonus|plus)\s*:?\s*$"),
    ("qualifications", r"(qualifications?|skills?\s*(and|&)?\s*experience)\s*:?\s*$"),
    ("responsibilities", r"(responsibilities?|what\s+you\s*[’']?ll\s+do|key\s+responsibilities)\s*:?\s*$"),
    ("about", r"(about\s+(us|the\s+role|you))\s*:?\s*$"),
    ("benefits", r"(benefits?|compensation|perks?)\s*:?\s*$"),
    ("legal", r"(equal\s+opportunity|eeoc|diversity|we\s+are\s+an\s+equal)\b"),
    ("education", r"(education|degree|certification)\s*:?\s*$"),
    ("overview", r"(overview|summary|position\s+summary)\s*:?\s*$"),
)
# Headings that open a line, and the section each stands for.
SECTION_OPENINGS = (
    ("preferred", r"preferred\s+qualifications?"),
    ("responsibilities", r"responsibilities?"),
    ("education", r"education"),
    ("qualifications", r"experience"),
    ("requirements", r"requirements?"),
    ("qualifications", r"(?:minimum|required)\s+qualifications?|qualifications?"),
)
# Words that make a short line ending in a colon a heading.
SECTION_WORDS = (("requirement", "requirements"), ("qualification", "qualifications"), ("responsibilit", "responsibilities"), ("preferred", "preferred"), ("benefit", "benefits"))
# Headings that begin a new line wherever they stand, applied one after another.
INLINE_HEADINGS = (
    r"Minimum\s+Qualifications?",
    r"Preferred\s+Qualifications?",
    r"Required\s+Qualifications?",
    r"Basic\s+Qualifications?",
    r"Key\s+Responsibilities",
    r"Primary\s+Responsibilities",
    r"Job\s+Responsibilities",
    r"Responsibilities?\s*:",
    r"Duties\s*(?:and\s+Responsibilities)?\s*:",
    r"Education\s*(?:requirements?)?\s*:",
    r"Experience\s*(?:requirements?)?\s*:",
    r"Skills\s*(?:and\s+)?(?:Experience|Required)\s*:?",
    r"What\s+You[’']?ll\s+Do",
    r"Qualifications?\s*:",
    r"Requirements?\s*:",
)
LONG_RESPONSIBILITIES = r"(\s*(?:Key\s+)?Responsibilities?\s*:)\s+(.{60,})"

# Cue words of line labels; each stands between word boundaries.
LEGAL_CUES = r"equal\s+opportunity|eeoc|affirmative\s+action|accommodation|disability|veteran\s+status|gender\s+identity|non-?discrimination|applicants\s+will\s+receive|consideration\s+for\s+employment"
BENEFIT_CUES = r"health\s+insurance|401k|pto|paid\s+time\s+off|dental|vision|stock\s+options|equity|bonus\s+structure|remote\s+work\s+benefits|unlimited\s+vacation|gym\s+membership"
MARKETING_CUES = r"world-?class|fast-?paced|rockstar|ninja|family|join\s+our\s+amazing|best\s+place\s+to\s+work|innovative\s+culture|passionate\s+team"
APPLY_CUES = r"apply\s+now|submit\s+your\s+resume|click\s+here\s+to\s+apply|no\s+phone\s+calls|recruiting\s+agency"
TECH_CUES = r"python|java|sql|aws|kubernetes|docker|agile|degree|years?\s+of"
SKILL_CUES = (
    r"experience|experienced|proficien|expertise|knowledge|familiar|skill|ability|hands-on|background|exposure|must\s+have|required\s*:|years?\s+of|bachelor|master|"
    r"ph\.?d\.?|certif|degree|programming|develop|engineer|technology|technologies|software|stack|framework|platform|using\s+[A-Za-z0-9]|with\s+[A-Za-z0-9]{2,}|"
    r"proficient\s+in|knowledge\s+of"
)
SKILLISH = r"experience|proficient|proficiency|expertise|knowledge|familiar|skill|ability|using|with|hands-on|background|exposure|must\s+have|preferred|years?"
TITLE_LINE = r"^[A-Z][A-Za-z\s/&]{2,50}$"

# Steps, points, limits and wording of the quality assessment.
LENGTH_STEPS = ((800, 0.25, "substantial length"), (200, 0.15, "moderate length"), (50, 0.08, "short but non-empty"))
LENGTH_ELSE = "very short description"
LINE_STEPS = ((5, 0.15, "multiple lines"), (1, 0.05, None))
HEADING_STEPS = ((1, 0.12, "section-like structure"),)
SKILL_STEPS = ((2, 0.22, "multiple skill-like lines"), (1, 0.10, "some skill-like phrasing"))
REPEAT_COST, REPEAT_SAID, REPEAT_WORDING = 0.15, 0.35, "high duplicate line ratio"
BAD_COST, BAD_SAID, BAD_WORDING = 0.12, 0.55, "mostly boilerplate/benefits/legal lines"
BLANK_WORDING = "missing or empty description"
BROKEN_CHARS, BROKEN_CHARS_NO_LINE, HEAVY_SHARE, LOW_SCORE, LOW_CHARS, COMPLETE_SCORE = 30, 80, 0.65, 0.2, 120, 0.45

BAD_LABELS = ("likely_boilerplate", "likely_benefits", "likely_legal", "likely_marketing")


def strip(c: Column) -> Column:
    """Without Unicode white space at both ends."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def once(df: DataFrame, **columns: Column) -> DataFrame:
    """``df`` with new columns, each computed once: later filters and projections can't pull the expression into themselves."""
    names = [c for c in df.columns if c not in columns]
    packed = df.select(*[F.col(f"`{c}`") for c in names], F.explode(F.array(F.struct(*[v.alias(k) for k, v in columns.items()]))).alias("_once"))
    return packed.select(*[F.col(f"`{c}`") for c in names], *[F.col(f"_once.{k}").alias(k) for k in columns])


def starts(text: Column, span: Column) -> Column:
    """All 0-based places of ``span`` in ``text``, overlapping ones too: a text is cut before each of them, and the pieces' lengths add up."""
    quoted = F.concat(F.lit(r"(?=\Q"), F.replace(span, F.lit(r"\E"), F.lit(r"\E\\E\Q")), F.lit(r"\E)"))
    empty = F.array().cast("array<int>")
    added = F.aggregate(
        F.split(text, quoted, -1),
        F.struct(F.lit(0).alias("at"), empty.alias("out")),
        lambda acc, piece: F.struct((acc["at"] + F.length(piece)).alias("at"), F.concat(acc["out"], F.array(acc["at"])).alias("out")),
        lambda acc: F.when(F.startswith(text, span), acc["out"]).otherwise(F.slice(acc["out"], F.lit(2), F.size(acc["out"]))),
    )
    return F.when((F.length(span) > 0) & F.contains(text, span), added).otherwise(empty)


def half_up(c: Column, digits: int = 4) -> Column:
    """Rounded by plain floating-point arithmetic, as other engines do it."""
    return F.floor(c * 10**digits + 0.5) / float(10**digits)


def has(c: Column, words: str) -> Column:
    return c.rlike(rf"(?iUd)\b(?:{words})\b")


def first_text(df_columns: list[str], types: dict[str, str], keys: tuple[str, ...]) -> Column:
    """The first non-blank string among ``keys``, stripped; '' if there is none. Columns of other types are skipped."""
    options = [F.when(strip(F.col(f"`{k}`")) != "", strip(F.col(f"`{k}`"))) for k in keys if k in df_columns and types[k] == "string"]
    return F.coalesce(*options, F.lit(""))


def normalize_text(c: Column) -> Column:
    """Line ends as \\n, runs of blanks as one space, lines stripped; blank lines stay. Null gives ''."""
    text = F.regexp_replace(F.coalesce(c, F.lit("")), r"\r\n?", "\n")
    text = F.regexp_replace(text, r"[ \t]+", " ")
    return F.regexp_replace(text, r"(?Udm)^[\s&&[^\n]]+|[\s&&[^\n]]+$", "")


def split_headings(c: Column) -> Column:
    """A line break before every inline heading; the rewrites follow each other, as later ones see what earlier ones did.

    A match starts at the first white space after other text; only there is anything else looked at.
    """
    text = reduce(lambda t, h: F.regexp_replace(t, rf"(?Ud)\s(?<=\S\s)\s*+((?i){h})", "\n$1"), INLINE_HEADINGS, c)
    return F.regexp_replace(text, rf"(?iUdm)^{LONG_RESPONSIBILITIES}$", "$1\n$2")


def section_header(s: Column) -> Column:
    """The section that a stripped line opens, null if none."""
    out = F.when(s == "", F.lit(None).cast("string"))
    for label, pattern in SECTION_LINES:
        out = out.when(s.rlike(rf"(?iUd)^{pattern}"), label)
    for label, pattern in SECTION_OPENINGS:
        out = out.when(s.rlike(rf"(?iUd)^(?:{pattern})\s*:\s*\S"), label)
    short = (F.length(s) < 80) & s.endswith(":")
    for word, label in SECTION_WORDS:
        out = out.when(short & F.lower(s).contains(word), label)
    return out


def line_label(s: Column, section: Column) -> Column:
    """The boilerplate label of a stripped line in its section."""
    sec = F.lower(F.coalesce(section, F.lit("")))
    return (
        F.when(s == "", "likely_boilerplate")
        .when(sec == "legal", "likely_legal")
        .when(sec == "benefits", "likely_benefits")
        .when(has(s, LEGAL_CUES), "likely_legal")
        .when(has(s, BENEFIT_CUES) & (F.length(s) < 300), "likely_benefits")
        .when(has(s, APPLY_CUES), "likely_boilerplate")
        .when(has(s, MARKETING_CUES) & ~has(s, TECH_CUES), "likely_marketing")
        .when(has(s, SKILL_CUES), "skills_relevant")
        .otherwise("uncertain")
    )


def with_quality(df: DataFrame, raw: str = "description_raw", normalized: str = "description_normalized", out: str = "quality_assessment", complete_min_score: float = COMPLETE_SCORE) -> DataFrame:
    """``df`` with the quality assessment of a description: struct of status, quality_score, reasons and six features.

    No shuffle and no Python; the lines are split and stripped once.
    """
    text = F.coalesce(F.col(normalized), F.lit(""))
    lines = F.when(text == "", F.array().cast("array<string>")).otherwise(F.transform(F.split(text, "\n", -1), strip))
    cut = once(df, _lines=lines)
    full = F.filter("_lines", lambda s: s != "")
    counted = once(
        cut,
        _chars=F.length(text),
        _n=F.size("_lines"),
        _full=F.size(full),
        _distinct=F.size(F.array_distinct(full)),
        _heads=F.size(F.filter("_lines", lambda s: (s != "") & (F.length(s) < 80) & (s.endswith(":") | s.rlike(f"(?Ud){TITLE_LINE}")))),
        _skillish=F.size(F.filter("_lines", lambda s: has(s, SKILLISH))),
        _bad=F.size(F.filter("_lines", lambda s: line_label(s, F.lit("body")).isin(*BAD_LABELS))),
    )
    c = F.col
    n_char, n_lines, heads, skillish = c("_chars"), c("_full"), c("_heads"), c("_skillish")
    dup = F.when(n_lines < 2, F.lit(0.0)).otherwise(1.0 - c("_distinct") / n_lines)
    bp = F.when(c("_n") == 0, F.lit(0.0)).otherwise(c("_bad") / c("_n"))
    blank = F.coalesce(strip(c(raw)), F.lit("")) == ""

    def points(value: Column, steps: tuple) -> Column:
        out = F.lit(0.0)
        for least, worth, _ in reversed(steps):
            out = F.when(value >= least, F.lit(worth)).otherwise(out)
        return out

    def wording(value: Column, steps: tuple, rest: str | None = None) -> Column:
        out = F.lit(rest)
        for least, _, words in reversed(steps):
            out = F.when(value >= least, F.lit(words)).otherwise(out)
        return out

    score = points(n_char, LENGTH_STEPS) + points(n_lines, LINE_STEPS) + points(heads, HEADING_STEPS) + points(skillish, SKILL_STEPS) - REPEAT_COST * F.least(dup, F.lit(1.0)) - BAD_COST * F.least(bp, F.lit(1.0))
    score = F.greatest(F.lit(0.0), F.least(F.lit(1.0), score))
    status = (
        F.when(blank, "malformed")
        .when((n_char < BROKEN_CHARS) | ((n_lines == 0) & (n_char < BROKEN_CHARS_NO_LINE)), "truncated_or_broken")
        .when((bp > HEAVY_SHARE) & (skillish == 0), "boilerplate_heavy")
        .when((score < LOW_SCORE) & (n_char < LOW_CHARS), "low_information")
        .when(score >= complete_min_score, "complete")
        .otherwise("low_information")
    )
    said = F.array(wording(n_char, LENGTH_STEPS, LENGTH_ELSE), wording(n_lines, LINE_STEPS), wording(heads, HEADING_STEPS), wording(skillish, SKILL_STEPS), F.when(dup > REPEAT_SAID, REPEAT_WORDING), F.when(bp > BAD_SAID, BAD_WORDING))
    reasons = F.when(blank, F.array(F.lit(BLANK_WORDING))).otherwise(F.filter(said, lambda r: r.isNotNull()))
    features = F.struct(n_char.alias("char_length"), n_lines.alias("non_empty_line_count"), heads.alias("section_header_like_lines"), skillish.alias("skillish_line_count"), dup.alias("duplicate_line_ratio"), bp.alias("boilerplate_line_ratio"))
    result = F.struct(status.alias("status"), F.when(blank, F.lit(0.0)).otherwise(half_up(score)).alias("quality_score"), reasons.alias("reasons"), features.alias("features"))
    return once(counted, **{out: result}).drop("_lines", "_chars", "_n", "_full", "_distinct", "_heads", "_skillish", "_bad")


def job_key(id_: Column, index: Column) -> Column:
    """J and the id with blanks as underscores, 80 characters of it at most; JIDX_ and the index where there is no id."""
    return F.when(strip(id_) != "", F.concat(F.lit("J"), F.substring(F.replace(id_, F.lit(" "), F.lit("_")), 1, 80))).otherwise(F.format_string("JIDX_%06d", index))
