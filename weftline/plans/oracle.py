"""DuckDB SQL for the core queries, written from their definitions. RE2 knows no look-behind and an ASCII ``\\b`` only."""

from __future__ import annotations

import sys
import unicodedata
from functools import cache

from weftline.functions import scoring as S
from weftline.functions import text as T
from weftline.operators import candidates as C
from weftline.operators import reports as R
from weftline.sources.sinks import MENTION_CSV

_WS = r"\t\n\x0B\f\r \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
_NW = r"[^\p{L}\p{M}\p{Nd}\p{Pc}\x{200C}\x{200D}]"


def re2(pattern: str) -> str:
    """A pattern with Unicode white space, for RE2."""
    out, i, inside = [], 0, False
    while i < len(pattern):
        two = pattern[i : i + 2]
        if two == r"\s":
            out.append(_WS if inside else f"[{_WS}]")
            i += 2
        elif two == r"\S":
            out.append(f"[^{_WS}]")
            i += 2
        elif two == r"\b":
            out.append(f"(?:$|{_NW})")
            i += 2
        elif two[0] == "\\":
            out.append(two)
            i += 2
        else:
            inside = two[0] == "[" or (inside and two[0] != "]")
            out.append(two[0])
            i += 1
    return "".join(out).replace("'", "''")


def strip(c: str) -> str:
    return f"regexp_replace({c}, '^[{_WS}]+|[{_WS}]+$', '', 'g')"


@cache
def _compatible() -> tuple[str, str]:
    """Characters with a compatibility form of one character, and those forms."""
    pairs = [(chr(i), unicodedata.normalize("NFKC", chr(i))) for i in range(0x80, sys.maxunicode + 1) if not 0xD800 <= i < 0xE000 and unicodedata.decomposition(chr(i)).startswith("<")]
    kept = [(a, b) for a, b in pairs if len(b) == 1 and a != b]
    return "".join(a for a, _ in kept), "".join(b for _, b in kept).replace("'", "''")


def nfkc(c: str) -> str:
    a, b = _compatible()
    return f"nfc_normalize(CASE WHEN regexp_matches({c}, '[^\\x00-\\x7F]') THEN translate({c}, '{a}', '{b}') ELSE {c} END)"


def half_up(c: str) -> str:
    return f"floor(({c}) * 10000 + 0.5) / 10000.0::DOUBLE"


def has(c: str, words: str) -> str:
    return f"regexp_matches({c}, '(?i)(?:^|{_NW})(?:{re2(words)})(?:$|{_NW})')"


def header(c: str) -> str:
    s = strip(c)
    out = [f"CASE WHEN {s} = '' THEN NULL"]
    for label, p in T.SECTION_LINES:
        out.append(f"WHEN regexp_matches({s}, '(?i)^{re2(p)}') THEN '{label}'")
    for label, p in T.SECTION_OPENINGS:
        out.append(f"WHEN regexp_matches({s}, '(?i)^(?:{re2(p)})[{_WS}]*:[{_WS}]*[^{_WS}]') THEN '{label}'")
    for word, label in T.SECTION_WORDS:
        out.append(f"WHEN length({s}) < 80 AND ends_with({s}, ':') AND contains(lower({s}), '{word}') THEN '{label}'")
    return " ".join(out) + " END"


def label(c: str, section: str) -> str:
    s = strip(c)
    return (
        f"CASE WHEN {s} = '' THEN 'likely_boilerplate' WHEN {section} = 'legal' THEN 'likely_legal' WHEN {section} = 'benefits' THEN 'likely_benefits' "
        f"WHEN {has(s, T.LEGAL_CUES)} THEN 'likely_legal' WHEN {has(s, T.BENEFIT_CUES)} AND length({s}) < 300 THEN 'likely_benefits' WHEN {has(s, T.APPLY_CUES)} THEN 'likely_boilerplate' "
        f"WHEN {has(s, T.MARKETING_CUES)} AND NOT {has(s, T.TECH_CUES)} THEN 'likely_marketing' WHEN {has(s, T.SKILL_CUES)} THEN 'skills_relevant' ELSE 'uncertain' END"
    )


def statements() -> dict[str, str]:
    def first(keys: list[str]) -> str:
        return "coalesce(" + ", ".join(f"nullif({strip(k)}, '')" for k in keys) + ", '')"

    jobs = "j AS (SELECT * FROM jobs QUALIFY row_number() OVER (PARTITION BY job_index ORDER BY ingested_at DESC NULLS LAST, description_raw DESC NULLS LAST, job_description DESC NULLS LAST, title_raw DESC NULLS LAST, job_title DESC NULLS LAST) = 1)"
    key = f"CASE WHEN {strip('id')} <> '' THEN 'J' || substring(replace(id, ' ', '_'), 1, 80) ELSE 'JIDX_' || lpad(job_index::VARCHAR, 6, '0') END"
    named = f"{jobs}, d0 AS (SELECT job_index, {key} AS job_key, {first(['job_title', 'title_raw'])} AS title, {first(['description_raw', 'job_description'])} AS description_raw FROM j)"
    lines_of = "string_split(replace(replace(description_raw, chr(13) || chr(10), chr(10)), chr(13), chr(10)), chr(10))"
    plain = f"{named}, d1 AS (SELECT *, array_to_string(list_transform({lines_of}, lambda x: {strip(chr(39).join(['regexp_replace(x, ', '[ \\t]+', ', ', ' ', ', ', 'g', ')']))}), chr(10)) AS n0 FROM d0)"
    split = "n0"
    for h in T.INLINE_HEADINGS:
        split = rf"regexp_replace({split}, '(?i)([^{_WS}])[{_WS}]+({re2(h)})', '\1' || chr(10) || '\2', 'g')"
    split = rf"regexp_replace({split}, '(?im)^{re2(T.LONG_RESPONSIBILITIES)}$', '\1' || chr(10) || '\2', 'g')"
    described = f"{plain}, d AS (SELECT job_index, job_key, title, description_raw, {split} AS norm FROM d1)"
    segmented = f"""{described}, l0 AS (SELECT job_index, job_key, unnest(string_split(norm, chr(10))) AS text, generate_subscripts(string_split(norm, chr(10)), 1) - 1 AS line_index FROM d WHERE norm <> ''),
        l1 AS (SELECT *, {header('text')} AS hdr FROM l0),
        l AS (SELECT job_index, job_key, job_key || '_L' || CASE WHEN line_index < 9999 THEN lpad((line_index + 1)::VARCHAR, 4, '0') ELSE (line_index + 1)::VARCHAR END AS line_id, line_index, text,
            coalesce(last_value(hdr IGNORE NULLS) OVER (PARTITION BY job_index ORDER BY line_index ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 'body') AS section,
            coalesce(sum(length(text) + 1) OVER (PARTITION BY job_index ORDER BY line_index ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::INT AS char_start FROM l1)"""
    labelled = f"{segmented}, ll AS (SELECT *, {label('text', 'section')} AS boilerplate_label FROM l)"
    shown = f"{strip('text')} <> '' AND boilerplate_label NOT IN ('likely_legal', 'likely_benefits')"
    q_lines = "CASE WHEN norm = '' THEN CAST([] AS VARCHAR[]) ELSE string_split(norm, chr(10)) END"
    quality = f"""{described}, q0 AS (SELECT job_index, description_raw, norm, {q_lines} AS ls FROM d), q1 AS (SELECT *, list_filter(list_transform(ls, lambda x: {strip('x')}), lambda x: x <> '') AS fl FROM q0),
        q2 AS (SELECT *, length(norm) AS char_length, len(fl) AS non_empty_line_count, len(list_filter(fl, lambda x: length(x) < 80 AND (ends_with(x, ':') OR regexp_matches(x, '{re2(T.TITLE_LINE)}')))) AS section_header_like_lines,
            len(list_filter(ls, lambda x: {has('x', T.SKILLISH)})) AS skillish_line_count, CASE WHEN len(fl) < 2 THEN 0.0::DOUBLE ELSE 1.0::DOUBLE - len(list_distinct(fl))::DOUBLE / len(fl) END AS dup,
            CASE WHEN len(ls) = 0 THEN 0.0::DOUBLE ELSE len(list_filter(ls, lambda x: ({label('x', "'body'")}) IN ('likely_boilerplate', 'likely_benefits', 'likely_legal', 'likely_marketing')))::DOUBLE / len(ls) END AS bp FROM q1),
        q3 AS (SELECT *, greatest(0.0::DOUBLE, least(1.0::DOUBLE, CASE WHEN char_length >= 800 THEN 0.25::DOUBLE WHEN char_length >= 200 THEN 0.15::DOUBLE WHEN char_length >= 50 THEN 0.08::DOUBLE ELSE 0.0::DOUBLE END + CASE WHEN non_empty_line_count >= 5 THEN 0.15::DOUBLE WHEN non_empty_line_count >= 1 THEN 0.05::DOUBLE ELSE 0.0::DOUBLE END
            + CASE WHEN section_header_like_lines >= 1 THEN 0.12::DOUBLE ELSE 0.0::DOUBLE END + CASE WHEN skillish_line_count >= 2 THEN 0.22::DOUBLE WHEN skillish_line_count = 1 THEN 0.10::DOUBLE ELSE 0.0::DOUBLE END - 0.15::DOUBLE * dup - 0.12::DOUBLE * bp)) AS score FROM q2),
        q AS (SELECT job_index, CASE WHEN description_raw = '' THEN 'malformed' WHEN char_length < 30 OR (non_empty_line_count = 0 AND char_length < 80) THEN 'truncated_or_broken' WHEN bp > 0.65 AND skillish_line_count = 0 THEN 'boilerplate_heavy' WHEN score < 0.2 AND char_length < 120 THEN 'low_information' WHEN score >= 0.45 THEN 'complete' ELSE 'low_information' END AS status,
            CASE WHEN description_raw = '' THEN 0.0::DOUBLE ELSE {half_up('score')} END AS quality_score,
            CASE WHEN description_raw = '' THEN 'missing or empty description' ELSE array_to_string(list_filter([CASE WHEN char_length >= 800 THEN 'substantial length' WHEN char_length >= 200 THEN 'moderate length' WHEN char_length >= 50 THEN 'short but non-empty' ELSE 'very short description' END, CASE WHEN non_empty_line_count >= 5 THEN 'multiple lines' END, CASE WHEN section_header_like_lines >= 1 THEN 'section-like structure' END,
                CASE WHEN skillish_line_count >= 2 THEN 'multiple skill-like lines' WHEN skillish_line_count = 1 THEN 'some skill-like phrasing' END, CASE WHEN dup > 0.35 THEN 'high duplicate line ratio' END, CASE WHEN bp > 0.55 THEN 'mostly boilerplate/benefits/legal lines' END], lambda x: x IS NOT NULL), '; ') END AS reasons,
            char_length, non_empty_line_count, section_header_like_lines, skillish_line_count, round(dup, 6) AS duplicate_line_ratio, round(bp, 6) AS boilerplate_line_ratio, norm FROM q3)"""
    mentions = r"m AS (SELECT DISTINCT *, regexp_extract(mention_id, '_M(\d+)$', 1)::INT AS mention_idx FROM skill_mentions)"
    stored = f"{mentions}, s AS (SELECT DISTINCT * FROM parsed_lines), s1 AS (SELECT line_id, section AS line_section, boilerplate_label, text AS source_line, char_start AS line_start FROM s WHERE line_id IS NOT NULL QUALIFY row_number() OVER (PARTITION BY line_id ORDER BY line_index, boilerplate_label NULLS LAST) = 1)"
    ran = "verifier_status IN ('accepted', 'rejected', 'parse_failed', 'error')"
    acc = "verifier_status = 'accepted'"

    def classified(value: str, words: str, default: str) -> tuple[str, str, str]:
        own = f"{value} IN ({words})"
        return (
            f"CASE WHEN {acc} THEN coalesce({value}, '{default}') WHEN {own} THEN {value} ELSE '{default}' END",
            f"CASE WHEN {acc} THEN CASE WHEN {value} IS NULL THEN 'parse_failed' ELSE 'completed' END WHEN {own} THEN 'extractor' ELSE 'skipped' END",
            f"CASE WHEN {acc} THEN final_confidence WHEN {own} THEN raw_model_confidence END",
        )

    req, req_s, req_c = classified("requirement_level", "'required', 'optional', 'unclear'", "unclear")
    hs, hs_s, hs_c = classified("hard_soft", "'hard', 'soft', 'unknown'", "unknown")
    own_conf = "CASE WHEN isnan(verifier_confidence) THEN NULL ELSE verifier_confidence END"
    merged = f"""{stored}, g AS (SELECT m.mention_id, m.job_index, m.job_key, m.mention_idx, coalesce(m.raw_model_confidence, 0.7) AS raw, s1.line_section AS section, s1.boilerplate_label, s1.source_line, s1.line_start, m.skill_span, m.char_start, m.evidence,
            CASE WHEN {ran} THEN {acc} AND coalesce(is_skill, true) ELSE coalesce(is_skill, true) END AS is_skill, CASE WHEN {ran} THEN verifier_status WHEN is_skill IS NOT NULL THEN 'extractor' ELSE 'skipped' END AS verifier_status,
            CASE WHEN {ran} THEN {own_conf} WHEN is_skill IS NOT NULL THEN raw_model_confidence END AS verifier_confidence,
            {req} AS requirement_level, {req_s} AS requirement_status, {req_c} AS requirement_confidence, {hs} AS hard_soft, {hs_s} AS hardsoft_status, {hs_c} AS hardsoft_confidence,
            coalesce(m.char_start >= 0 AND substring(s1.source_line, m.char_start - s1.line_start + 1, length(m.skill_span)) = m.skill_span, false) AS offset_valid, coalesce(m.evidence <> '' AND contains(s1.source_line, m.evidence), false) AS evidence_ok
            FROM m JOIN s1 USING (line_id))"""
    done = lambda x: f"({x}_status IN ('accepted', 'completed') AND {x}_confidence IS NOT NULL)"
    rule_bonus = "+ 0.0::DOUBLE"
    conf = f"""{merged}, f0 AS (SELECT *, CASE verifier_status WHEN 'parse_failed' THEN raw - 0.18::DOUBLE WHEN 'error' THEN raw - 0.12::DOUBLE ELSE CASE WHEN verifier_status IN ('accepted', 'rejected') AND verifier_confidence IS NOT NULL THEN 0.45::DOUBLE * raw + 0.55::DOUBLE * verifier_confidence ELSE raw END END AS s0,
            {done('requirement')}::INT + {done('hardsoft')}::INT AS n, (CASE WHEN {done('requirement')} THEN requirement_confidence ELSE 0 END + CASE WHEN {done('hardsoft')} THEN hardsoft_confidence ELSE 0 END) AS total FROM g),
        f AS (SELECT mention_id, greatest(0.0::DOUBLE, least(1.0::DOUBLE, floor((CASE WHEN n > 0 THEN 0.7::DOUBLE * s0 + 0.3::DOUBLE * (total / n) ELSE s0 END - CASE requirement_status WHEN 'parse_failed' THEN 0.08::DOUBLE WHEN 'error' THEN 0.06::DOUBLE ELSE 0.0::DOUBLE END - CASE hardsoft_status WHEN 'parse_failed' THEN 0.08::DOUBLE WHEN 'error' THEN 0.06::DOUBLE ELSE 0.0::DOUBLE END
            + CASE section WHEN 'requirements' THEN 0.06::DOUBLE WHEN 'qualifications' THEN 0.05::DOUBLE WHEN 'preferred' THEN 0.03::DOUBLE WHEN 'education' THEN 0.03::DOUBLE WHEN 'responsibilities' THEN 0.02::DOUBLE ELSE 0.0::DOUBLE END + 0.0::DOUBLE
            - CASE WHEN boilerplate_label IN ('likely_legal', 'likely_benefits', 'likely_marketing', 'likely_boilerplate') THEN 0.14::DOUBLE WHEN boilerplate_label = 'uncertain' THEN 0.04::DOUBLE ELSE 0.0::DOUBLE END - CASE WHEN offset_valid THEN 0.0::DOUBLE ELSE 0.12::DOUBLE END - CASE WHEN evidence_ok THEN 0.0::DOUBLE ELSE 0.06::DOUBLE END) * 10000 + 0.5) / 10000.0::DOUBLE)) AS final_confidence FROM f0)"""
    base = f"trim(regexp_replace(regexp_replace(lower({strip(nfkc('name'))}), '[{_WS}]+', ' ', 'g'), '(?i)[{_WS}]+(skills?|proficiency|expertise|knowledge|experience|abilities|ability)$', ''), ' .,;:-/')"
    stem = f"regexp_replace(b, '(?i)[{_WS}]+(programming|language|framework|platform|tools?|software|technologies|technology|development|applications?)$', '')"
    canon = f"""{mentions}, al AS (SELECT lower(a) AS alias, min(lower(canonical_skill)) AS target FROM (SELECT canonical_skill, unnest(aliases) AS a FROM skill_reference) GROUP BY 1),
        k0 AS (SELECT *, {strip("coalesce(skill_span, '')")} AS span, {strip("coalesce(nullif(normalized_candidate, ''), " + strip("coalesce(skill_span, '')") + ")")} AS name FROM m WHERE is_skill), k1 AS (SELECT *, {base} AS b FROM k0 WHERE name <> ''), k2 AS (SELECT *, {stem} AS st FROM k1),
        k AS (SELECT k2.*, coalesce(x.target, y.target, b) AS canonical_key, coalesce(hard_soft, 'unknown') AS type, coalesce(requirement_level, 'unclear') AS requirement, coalesce(job_id, '') AS job, {strip("coalesce(title_raw, '')")} AS title FROM k2 LEFT JOIN al x ON x.alias = b LEFT JOIN al y ON y.alias = st AND st <> b WHERE coalesce(x.target, y.target, b) <> '')"""

    def mode(value: str) -> str:
        return f"(SELECT canonical_key, {value}, count(*) AS n, min((job_index, mention_idx)) AS seen FROM k GROUP BY 1, 2)"

    onto = f"""{canon}, ob AS (SELECT canonical_key, count(*) AS mention_count, count(DISTINCT job) AS job_count, min((job_index, mention_idx)) AS first_at, {half_up('sum(final_confidence::DECIMAL(18, 6))::DOUBLE / count(final_confidence)')} AS avg_confidence, round(min(final_confidence), 4) AS confidence_min, round(max(final_confidence), 4) AS confidence_max FROM k GROUP BY 1),
        ot AS (SELECT canonical_key, first(type ORDER BY n DESC, seen, type) AS type, string_agg(type || '=' || n, ';' ORDER BY type) AS type_distribution FROM {mode('type')} GROUP BY 1), orq AS (SELECT canonical_key, first(requirement ORDER BY n DESC, seen, requirement) AS requirement_level, string_agg(requirement || '=' || n, ';' ORDER BY requirement) AS requirement_distribution FROM {mode('requirement')} GROUP BY 1),
        ov AS (SELECT canonical_key, list(DISTINCT v) AS vs FROM (SELECT canonical_key, name AS v FROM k UNION ALL SELECT canonical_key, span FROM k WHERE span <> '') GROUP BY 1),
        od AS (SELECT canonical_key, vs, coalesce((list_sort(list_filter(vs, lambda v: regexp_matches(v, '^\\p{{Lu}}') AND lower(v) = canonical_key)))[1], (list_sort(vs))[1]) AS canonical_skill FROM ov),
        oc AS (SELECT canonical_key, string_agg(title, '; ' ORDER BY rk) AS common_contexts FROM (SELECT canonical_key, title, row_number() OVER (PARTITION BY canonical_key ORDER BY n DESC, seen, title) AS rk FROM (SELECT canonical_key, title, count(*) AS n, min((job_index, mention_idx)) AS seen FROM k WHERE title <> '' GROUP BY 1, 2)) WHERE rk <= 10 GROUP BY 1),
        o AS (SELECT ob.*, ot.type, type_distribution, requirement_level, requirement_distribution, canonical_skill, array_to_string(list_sort(list_filter(vs, lambda v: lower(v) <> lower(canonical_skill))), '; ') AS variants, coalesce(common_contexts, '') AS common_contexts FROM ob JOIN ot USING (canonical_key) JOIN orq USING (canonical_key) JOIN od USING (canonical_key) LEFT JOIN oc USING (canonical_key))"""
    quals = "programming|language|framework|platform|tools|tool|software|technologies|technology|development|applications|application"
    dup = rf"""{onto}, e AS (SELECT canonical_key AS k, canonical_skill AS skill, job_count AS jobs FROM o),
        rules AS (SELECT k, skill, jobs, 1 AS p, 'microsoft_prefix' AS reason, substring(k, 11) AS base FROM e WHERE starts_with(k, 'microsoft ') UNION ALL SELECT k, skill, jobs, 2, 'ms_prefix', substring(k, 4) FROM e WHERE starts_with(k, 'ms ') UNION ALL SELECT k, skill, jobs, 3, 'qualifier_suffix', regexp_replace(k, ' (?:{quals})$', '') FROM e WHERE regexp_matches(k, ' (?:{quals})$') UNION ALL SELECT k, skill, jobs, 4, 'version_variant', regexp_replace(k, '[{_WS}]+\d+(\.\d+)*(\.x)?$', '') FROM e WHERE regexp_matches(k, '[{_WS}]+\d+(\.\d+)*(\.x)?$')),
        aff AS (SELECT r.k AS key_a, e.k AS key_b, r.skill AS skill_a, r.jobs AS skill_a_jobs, e.skill AS skill_b, e.jobs AS skill_b_jobs, reason, CASE WHEN p <= 2 AND e.jobs < r.jobs THEN r.skill ELSE e.skill END AS suggested_target, p FROM rules r JOIN e ON e.k = r.base WHERE r.jobs >= 2),
        ins AS (SELECT s.k, l.k AS lk, s.skill, s.jobs, l.skill AS ls, l.jobs AS lj, 'substring_containment', CASE WHEN s.jobs >= l.jobs THEN s.skill ELSE l.skill END, 5 FROM e s JOIN e l ON length(s.k) >= 3 AND length(s.k) < length(l.k) AND s.jobs >= 2 AND l.jobs >= 2 AND greatest(s.jobs, l.jobs) >= 20 AND contains(l.k, s.k) AND regexp_matches(l.k, CASE WHEN regexp_matches(s.k, '^[\p{{L}}\p{{N}}_]') THEN '(?:^|{_NW})' ELSE '[\p{{L}}\p{{N}}_]' END || regexp_escape(s.k) || CASE WHEN regexp_matches(s.k, '[\p{{L}}\p{{M}}\p{{N}}_]$') THEN '(?:$|{_NW})' ELSE '[\p{{L}}\p{{N}}_]' END)),
        un AS (SELECT * FROM aff UNION ALL SELECT * FROM ins) SELECT * EXCLUDE (p) FROM un QUALIFY row_number() OVER (PARTITION BY least(key_a, key_b), greatest(key_a, key_b) ORDER BY p, key_a) = 1"""

    def titles(mapped: bool) -> str:
        t = "SELECT DISTINCT job_index, job_id, title_raw FROM m"
        raw = f"SELECT job_index, coalesce(job_id, '') AS job, {strip(chr(39).join(['coalesce(title_raw, ', '', ')']))} AS raw FROM ({t})"
        if mapped:
            rows = f"SELECT job_index, job, family || ': ' || normalized_title AS title FROM ({raw}) r JOIN title_reference n ON n.normalized_title = r.raw WHERE raw <> ''"
        else:
            rows = f"SELECT job_index, job, lower(raw) AS title FROM ({raw}) WHERE raw <> ''"
        return f"""{canon}, tt AS ({rows}), kk AS (SELECT * FROM k WHERE final_confidence IS NULL OR final_confidence >= 0.6), on1 AS (SELECT job_index, canonical_key, type, min(mention_idx) AS mention_idx FROM kk GROUP BY ALL), met AS (SELECT tt.title, on1.canonical_key, on1.type, tt.job, on1.job_index, on1.mention_idx FROM on1 JOIN tt USING (job_index)),
            vt AS (SELECT title, canonical_key, first(type ORDER BY n DESC, seen, type) AS type FROM (SELECT title, canonical_key, type, count(*) AS n, min((job_index, mention_idx)) AS seen FROM met GROUP BY 1, 2, 3) GROUP BY 1, 2), po AS (SELECT title, canonical_key, count(DISTINCT job) AS posting_count FROM met GROUP BY 1, 2),
            nv AS (SELECT canonical_key, list(DISTINCT name) AS vs FROM kk WHERE job_index IN (SELECT job_index FROM tt) GROUP BY 1), dn AS (SELECT canonical_key, coalesce((list_sort(list_filter(vs, lambda v: regexp_matches(v, '^\\p{{Lu}}') AND lower(v) = canonical_key)))[1], (list_sort(vs))[1]) AS skill FROM nv), jc AS (SELECT title, count(DISTINCT job) AS job_count FROM tt GROUP BY 1),
            ts AS (SELECT po.title, job_count, po.canonical_key, skill, round(posting_count * CASE WHEN vt.type = 'hard' THEN 1.0 ELSE 0.5 END, 1)::DOUBLE AS points, vt.type, posting_count FROM po JOIN vt USING (title, canonical_key) JOIN dn USING (canonical_key) JOIN jc USING (title))"""

    per_job = f"{mentions}, pj AS (SELECT x.job_index, coalesce(n, 0) AS n FROM (SELECT DISTINCT job_index FROM jobs) x LEFT JOIN (SELECT job_index, count(*) AS n FROM m GROUP BY 1) USING (job_index))"

    def classes(source: str, value: str, bounds: tuple) -> str:
        name, pos = [], []
        for i, (a, b) in enumerate(bounds):
            inside = " AND ".join([f"{value} >= {a}"] * (a is not None) + [f"{value} <= {b}"] * (b is not None))
            label_ = f"{a}" if a == b else f"{a}+" if b is None else f"{b} or less" if a is None else f"{a} to {b}"
            name.append(f"WHEN {inside} THEN '{label_}'")
            pos.append(f"WHEN {inside} THEN {i}")
        return f"SELECT CASE {' '.join(name)} END AS class, CASE {' '.join(pos)} END AS position, count(*) AS n FROM {source} GROUP BY 1, 2"

    cmp_ = f"""{mentions}, ra AS (SELECT job_index, count(*) AS n_a FROM m WHERE coalesce(requirement_level = 'required', false) GROUP BY 1), rb AS (SELECT job_index, count(*) AS n_b FROM m WHERE NOT coalesce(requirement_level = 'required', false) GROUP BY 1),
        cp AS (SELECT job_index, n_a, n_b, n_b - n_a AS difference, CASE WHEN n_a IS NULL THEN 'only_b' WHEN n_b IS NULL THEN 'only_a' ELSE 'both' END AS side FROM ra FULL JOIN rb USING (job_index))"""
    calls = "c AS (SELECT event_id AS call_id, ts, event_type AS model, CASE WHEN event_type = 'view' THEN 'extractor' ELSE 'skill_verifier' END AS role, value AS wall_time, length(props) * 40 AS resp_chars, (props::JSON->>'$.k')::INT AS eval_tokens, (props::JSON->>'$.k')::DOUBLE AS tok_s FROM events)"

    def stats(by: str, source: str = "c") -> str:
        mean = lambda x: half_up(f"sum({x}::DECIMAL(18, 6))::DOUBLE / count({x})")
        return f"SELECT {by}, count(*) AS calls, round(sum(wall_time::DECIMAL(18, 6))::DOUBLE, 4) AS wall, sum(eval_tokens)::BIGINT AS tokens, {mean('wall_time')} AS avg_wall, {mean('tok_s')} AS avg_tok_s FROM {source} GROUP BY ALL"

    w = R.WINDOW_ROWS
    back, ahead = f"(PARTITION BY model ORDER BY ts, call_id ROWS BETWEEN {w} PRECEDING AND 1 PRECEDING)", f"(PARTITION BY model ORDER BY ts, call_id ROWS BETWEEN CURRENT ROW AND {w - 1} FOLLOWING)"
    mean = lambda x, o: f"(sum(({x})::DECIMAL(18, 6)) OVER {o})::DOUBLE / {w}"
    ratio = "resp_chars / greatest(eval_tokens, 1)"
    trans = f"""{calls}, pl AS (SELECT model, ts, row_number() OVER (PARTITION BY model ORDER BY ts, call_id) - 1 AS position, count(*) OVER (PARTITION BY model) AS n, {mean('tok_s', back)} AS sb, {mean('tok_s', ahead)} AS sa, {mean(ratio, back)} AS rb, {mean(ratio, ahead)} AS ra FROM c),
        ins AS (SELECT * FROM pl WHERE position >= {w} AND position < n - {w}),
        tr AS (SELECT model, position, ts, {half_up('sb')} AS before, {half_up('sa')} AS after, 'speed' AS kind FROM ins WHERE sa - sb > {R.JUMP} AND sb < {R.JUMP_BELOW} UNION ALL SELECT model, position, ts, {half_up('rb')}, {half_up('ra')}, 'ratio' FROM ins WHERE rb - ra > {R.DROP} AND rb > {R.DROP_ABOVE})"""

    def top(cond: str, k: int, s: str) -> str:
        return f"(SELECT normalized_candidate AS value, count(*) AS n_{s}, row_number() OVER (ORDER BY count(*) DESC, normalized_candidate) AS rank_{s} FROM m WHERE normalized_candidate IS NOT NULL AND {cond} GROUP BY 1 QUALIFY rank_{s} <= {k})"

    # candidates: RE2's boundary is one of ASCII, so for patterns of ASCII tokens other letters are read as underscores first
    stops = ", ".join(f"'{w}'" for w in sorted(C.STOP_WORDS))

    def stop(w: str) -> str:
        return f"(length({w}) < 2 OR lower({w}) IN ({stops}) OR (lower({w}) LIKE '%ing' AND length({w}) > 5 AND lower({w})[:-4] IN ({stops})) OR (lower({w}) LIKE '%s' AND length({w}) > 4 AND lower({w})[:-2] IN ({stops})))"

    def tidy(c: str) -> str:
        return f"trim(regexp_replace({strip(c)}, '[{_WS}]+', ' ', 'g'), ' ' || chr(9) || '.;:')"

    raw = lambda p: p.replace(r"\s", f"[{_WS}]").replace(f"[A-Za-z0-9+.#[{_WS}]\\-]", f"[A-Za-z0-9+.#{_WS}\\-]").replace(f"[:[{_WS}]]", f"[:{_WS}]").replace("'", "''")
    shape = "(regexp_matches(f, '[0-9+#.]') OR regexp_matches(f, '^[A-Z]{2,10}$') OR regexp_matches(f, '" + C.TOOLISH + "') OR regexp_matches(f, '[a-z][A-Z]|[A-Z][a-z]+[A-Z]'))"

    def mined(source: str) -> str:
        """Common table expressions from ``source`` (lines with labels) to ``mc``, the candidates."""
        found = [f"SELECT *, {i} AS r, '{name}' AS rule, unnest(regexp_extract_all(text, '{raw(p)}', 1, 'i')) AS f, generate_subscripts(regexp_extract_all(text, '{raw(p)}', 1, 'i'), 1) AS k FROM ml" for i, (name, p) in enumerate(C.PATTERNS.items())]
        phrase = f"SELECT * FROM (SELECT *, 4 AS r, 'prep_phrase_strong' AS rule, unnest(regexp_extract_all(text, '{raw(C.PHRASE)}', 1, 'i')) AS f, generate_subscripts(regexp_extract_all(text, '{raw(C.PHRASE)}', 1, 'i'), 1) AS k FROM ml) WHERE length({strip('f')}) >= 2 AND NOT {stop('string_split_regex(' + strip('f') + ', ' + chr(39) + '[' + _WS + ']+' + chr(39) + ')[1]')}"
        tokens = f"SELECT * FROM (SELECT *, 5 AS r, 'comma_list_token' AS rule, unnest(regexp_extract_all(plain, '{raw(C.LIST_TOKEN)}', 1)) AS f, generate_subscripts(regexp_extract_all(plain, '{raw(C.LIST_TOKEN)}', 1), 1) AS k FROM ml WHERE allowed AND regexp_matches(plain, '{raw(C.TWO_IN_A_LIST)}')) WHERE length(f) BETWEEN 2 AND 42 AND {shape} AND NOT {stop('f')}"

        def placed(frm: str, to: str) -> str:
            return f"""{to}w AS (SELECT * EXCLUDE (f), {tidy('f')} AS w FROM {frm}),
            {to}p AS (SELECT * EXCLUDE (w), w AS t, strpos(text, w) - 1 AS pos, 0 AS k2, 0 AS k3 FROM {to}w WHERE length(w) >= 2 AND contains(text, w) UNION ALL
                SELECT * EXCLUDE (w, parts, k2, t), t, unnest(list_filter(range(length(text)), lambda i: substring(text, i + 1, length(t)) = t)) AS pos, k2, 0 AS k3 FROM
                    (SELECT *, unnest(list_transform(parts, lambda x: {tidy('x')})) AS t, generate_subscripts(parts, 1) AS k2 FROM (SELECT *, string_split_regex(w, '(?i){raw(C.LIST_SPLIT)}') AS parts FROM {to}w WHERE length(w) >= 2 AND NOT contains(text, w))) WHERE length(t) >= 2),
            {to}c AS (SELECT * FROM {to}p WHERE NOT {stop('t')} QUALIFY row_number() OVER (PARTITION BY job_index, line_id, line_index, pos, t ORDER BY r, k, k2, pos) = 1)"""

        return f"""ml AS (SELECT job_index, line_id, line_index, section, text, boilerplate_label, char_start, regexp_replace(regexp_replace(text, '[^\\x00-\\x7F\\P{{L}}]', '_', 'g'), '[^\\x00-\\x7F\\P{{N}}]', '_', 'g') AS plain, regexp_matches(text, '(?i){raw(C.CUES)}') AS cued, lower(section) IN ({", ".join(f"'{x}'" for x in C.REQUIREMENT_SECTIONS)}) OR regexp_matches(text, '(?i){raw(C.CUES)}') AS allowed
                FROM {source} WHERE NOT (boilerplate_label IN ('likely_legal', 'likely_benefits') AND length(text) < 200)),
            mf AS ({' UNION ALL '.join([*found, phrase, tokens])}), {placed('mf', 'a')},
            mt AS (SELECT *, 6 AS r, 'post_colon_fragment' AS rule, {strip("substring(text, strpos(text, ':') + 1)")} AS f, 1 AS k FROM ml WHERE length(text) > 15 AND contains(text, ':') AND cued AND (allowed OR boilerplate_label = 'skills_relevant') AND NOT EXISTS (SELECT 1 FROM ac WHERE ac.job_index = ml.job_index AND ac.line_id = ml.line_id)),
            mu AS (SELECT * FROM mt WHERE length(f) > 3 AND length(f) < 120), {placed('mu', 'b')},
            mc AS (SELECT job_index, line_id, (row_number() OVER (PARTITION BY job_index, line_id ORDER BY r, k, k2, pos) - 1)::INT AS ordinal, t AS candidate_text, (char_start + pos)::INT AS char_start, (char_start + pos + length(t))::INT AS char_end, rule AS rule_source, section, substring(text, greatest(pos - 40, 0) + 1, 200) AS context_window FROM (SELECT * FROM ac UNION ALL SELECT * FROM bc))"""

    labelled_mc = f"{labelled}, {mined('ll')}"
    stored_mc = f"{mentions}, sl AS (SELECT * REPLACE (coalesce(boilerplate_label, 'uncertain') AS boilerplate_label) FROM (SELECT DISTINCT * FROM parsed_lines)), {mined('sl')}"
    fired = f"rf AS (SELECT m.mention_id, list(DISTINCT rule_source) AS rules, list(rule_source ORDER BY ordinal) AS ordered FROM m JOIN mc ON m.line_id = mc.line_id AND mc.char_start < m.char_end AND m.char_start < mc.char_end WHERE m.char_start >= 0 GROUP BY 1)"
    ruled = conf.replace("FROM m JOIN s1 USING (line_id))", f"FROM m JOIN s1 USING (line_id)), sl AS (SELECT * REPLACE (coalesce(boilerplate_label, 'uncertain') AS boilerplate_label) FROM s), {mined('sl')}, {fired}, g2 AS (SELECT g.*, coalesce(len(rules), 0) AS n_rules FROM g LEFT JOIN rf USING (mention_id))", 1)
    with_rules = ruled.replace("AS total FROM g)", "AS total FROM g2)").replace("f AS (SELECT mention_id,", "f AS (SELECT mention_id, n_rules,").replace(rule_bonus, f"+ least({S.RULES_AT_MOST}::DOUBLE, n_rules * {S.RULE_WORTH}::DOUBLE)")
    firsts = "array_to_string(list_filter(ordered, lambda x, i: list_position(ordered, x) = i), ';')"

    # spans on lines: a mention's places in order of preference, and a walk along the mentions of one span
    grounded = f"""{mentions}, gs AS (SELECT DISTINCT * FROM parsed_lines), ga AS (SELECT job_index, mention_idx, skill_span AS span, CASE WHEN {strip("coalesce(evidence, '')")} <> '' THEN evidence END AS ctx, lower(CASE WHEN {strip("coalesce(section, '')")} <> '' THEN section ELSE 'General' END) AS hint FROM m WHERE {strip("coalesce(skill_span, '')")} <> ''),
        gl AS (SELECT ga.*, gs.line_index, gs.line_id, gs.text, gs.char_start, contains(text, span) AS exact, CASE WHEN lower(coalesce(gs.section, '')) = hint THEN 1 ELSE 2 END AS rank, list_filter(range(length(text)), lambda i: CASE WHEN contains(text, span) THEN substring(text, i + 1, length(span)) = span ELSE substring(lower(text), i + 1, length(span)) = lower(span) END) AS spots FROM ga JOIN gs ON ga.job_index = gs.job_index AND (contains(text, span) OR contains(lower(text), lower(span)))),
        go AS (SELECT DISTINCT job_index, mention_idx, span, rank, line_index, line_id, char_start, text, unnest(spots) AS pos FROM gl UNION SELECT job_index, mention_idx, span, 0, line_index, line_id, char_start, text, spots[1] FROM gl WHERE exact AND contains(text, ctx)),
        gp AS (SELECT *, row_number() OVER (PARTITION BY job_index, span ORDER BY mention_idx) AS k FROM (SELECT job_index, mention_idx, span, list({{'rank': rank, 'place': line_id || ':' || pos, 'line_id': line_id, 'pos': pos, 'cs': char_start + pos, 'ok': substring(text, pos + 1, length(span)) = span}} ORDER BY rank, line_index, pos, line_id) AS options FROM go GROUP BY ALL)),
        gw AS (SELECT job_index, span, 0::BIGINT AS k, CAST([] AS VARCHAR[]) AS used, NULL::INT AS mention_idx, NULL::VARCHAR AS line_id, NULL::BIGINT AS cs, NULL::BOOLEAN AS ok FROM (SELECT DISTINCT job_index, span FROM gp) UNION ALL
            SELECT job_index, span, k, list_append(used, o.place), mention_idx, o.line_id, o.cs, o.ok FROM (SELECT gp.job_index, gp.span, gp.k, used, gp.mention_idx, coalesce(list_filter(options, lambda x: NOT list_contains(used, x.place))[1], list_filter(options, lambda x: x.rank > 0)[1]) AS o FROM gw JOIN gp ON gp.job_index = gw.job_index AND gp.span = gw.span AND gp.k = gw.k + 1))"""
    chunked = f"""{segmented}, cl AS (SELECT job_index, line_id, line_index, greatest(1, length(text)) AS size, lower(section) AS section FROM l),
        cw AS (SELECT job_index, line_id, line_index, size AS chars, 1 AS n, section, 0 AS chunk FROM cl WHERE line_index = 0 UNION ALL
            SELECT job_index, line_id, line_index, CASE WHEN cut THEN size ELSE chars + size + 1 END, CASE WHEN cut THEN 1 ELSE n + 1 END, section, chunk + cut::INT FROM
                (SELECT cl.job_index, cl.line_id, cl.line_index, cl.size, cl.section, cw.chars, cw.n, cw.chunk, cw.chars + cl.size + 1 > 5000 OR cw.n >= 24 OR (cl.section <> cw.section AND cw.chars >= 2500) AS cut FROM cw JOIN cl ON cl.job_index = cw.job_index AND cl.line_index = cw.line_index + 1))"""
    hashed = lambda role, span, line, text: f"('0x' || md5('{role}|' || {span} || '|' || {line} || '|' || {text})[1:8])::BIGINT"
    sure = lambda h: f"round(0.5 + {h} % 50 / 100, 2)"
    asked = f"{stored}, v AS (SELECT job_index, mention_idx, skill_span AS span, coalesce(line_section, '') AS sec, coalesce(source_line, '') AS line FROM m JOIN s1 USING (line_id))"

    def verdict(role: str, value: str, expression: str) -> str:
        h = hashed(role, "span", "line", "''")
        status = f"CASE WHEN {h} % 10 <> 0 THEN 'accepted' ELSE 'rejected' END" if role == "verify" else "'completed'"
        return f"WITH {asked} SELECT job_index, mention_idx, {status} AS status, {expression.replace('HASH', h)} AS {value}, {sure(h)} AS confidence, span AS evidence, '' AS notes, 'stub' AS model FROM v"

    def extracted(source: str, keys: str) -> str:
        """The stub's reply to ``xs`` (keys, text): terms between word boundaries, from the left, the longest at a place, without overlap."""
        letter = r"[\p{L}\p{N}_]"
        both = keys.split(", ")
        on = lambda a, b: " AND ".join(f"{a}.{k} = {b}.{k}" for k in both)
        h = hashed("extract", "''", "''", "text")
        return f"""WITH RECURSIVE {source}, xt AS (SELECT canonical_skill AS term FROM skill_reference),
            xo AS (SELECT {keys}, a, max(a + length(term)) AS b FROM (SELECT {keys}, text, term, unnest(list_filter(range(length(text)), lambda i: substring(lower(text), i + 1, length(term)) = lower(term))) AS a FROM xs JOIN xt ON contains(lower(text), lower(term)))
                WHERE NOT regexp_matches(substring(text, a, CASE WHEN a > 0 THEN 1 ELSE 0 END), '{letter}') AND NOT regexp_matches(substring(text, a + length(term) + 1, 1), '{letter}') GROUP BY ALL),
            xw AS (SELECT {keys}, min(a) AS a, 0 AS k FROM xo GROUP BY ALL UNION ALL SELECT {keys}, min(a2), k + 1 FROM (SELECT {', '.join('w.' + k for k in both)}, w.k, n.a AS a2 FROM xw w JOIN xo c ON {on('c', 'w')} AND c.a = w.a JOIN xo n ON {on('n', 'w')} AND n.a >= c.b) GROUP BY ALL),
            xm AS (SELECT {', '.join('xs.' + k for k in both)}, k AS mention_idx, substring(text, xo.a + 1, b - xo.a) AS skill_span, string_split(regexp_extract(substring(text, 1, xo.a), '[^\n]*$') || substring(text, xo.a + 1), chr(10))[1] AS line, {sure(h)} AS conf FROM xw JOIN xo ON {on('xo', 'xw')} AND xo.a = xw.a JOIN xs ON {on('xs', 'xw')})
            SELECT {keys}, mention_idx, skill_span, line AS context, 'General' AS section_hint, (SELECT max(term) FROM xt WHERE lower(term) = lower(skill_span)) AS normalized_candidate, line AS evidence, conf AS raw_model_confidence, 'unclear' AS requirement_level, 'hard' AS hard_soft, 'stub' AS extractor_model, NULL::VARCHAR AS error FROM xm
            UNION ALL SELECT {keys}, -1, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, 'stub', NULL FROM xs WHERE NOT EXISTS (SELECT 1 FROM xm WHERE {on('xm', 'xs')})"""

    def apart(source: str, keys: str, distance: int, to: str) -> str:
        both = keys.split(", ")
        on = " AND ".join(f"t.{k} = w.{k}" for k in both)
        return f"{to} AS (SELECT {keys}, min(position) AS position FROM {source} GROUP BY ALL UNION ALL SELECT {keys}, min(p2) AS position FROM (SELECT {', '.join('w.' + k for k in both)}, w.position, t.position AS p2 FROM {to} w JOIN {source} t ON {on} AND t.position > w.position + {distance}) GROUP BY ALL)"

    apart_ = f"{trans}, {apart('tr', 'model, kind', R.APART, 'ka')}"
    phased = f"{apart_}, kb AS (SELECT DISTINCT model, position FROM ka), {apart('kb', 'model', R.APART_MERGED, 'kc')}, cu AS (SELECT model, list_sort(list(position))[:2] AS cuts FROM kc GROUP BY 1)"

    stored_columns = "run_id job_id line_id mention_id title_raw section skill_span normalized_candidate hard_soft requirement_level char_start char_end evidence raw_model_confidence final_confidence extractor_model verifier_status is_skill".split()
    needed = "coalesce(requirement_level = 'required', false)"
    fields = ["job_id", "line_id", "title_raw", "section", "normalized_candidate", "hard_soft", "requirement_level", "evidence"]
    kinds = ["verifier_status", "is_skill", "hard_soft", "requirement_level", "extractor_model"]
    name_lower = f"lower({strip(chr(39).join(['coalesce(nullif(normalized_candidate, ', '', '), skill_span, ', '', ')']))})"
    return {
        "job_keys": f"WITH {named} SELECT job_index, job_key FROM d0",
        "title_coalesce": f"WITH {named} SELECT job_index, title FROM d0",
        "description_coalesce": f"WITH {named} SELECT job_index, description_raw FROM d0",
        "normalize_text": f"WITH {plain} SELECT job_index, n0 AS description_normalized FROM d1",
        "split_headers": f"WITH {described} SELECT job_index, norm AS description_normalized FROM d",
        "segment_lines": f"WITH {segmented} SELECT job_index, line_id, line_index, section, text, char_start, char_start + length(text) AS char_end FROM l",
        "line_labels": f"WITH {labelled} SELECT line_id, job_index, line_index, boilerplate_label FROM ll",
        "label_histogram": f"WITH {labelled} SELECT section, boilerplate_label, count(*) AS n FROM ll GROUP BY 1, 2",
        "extraction_lines": f"WITH {labelled} SELECT job_index, line_index, text FROM ll WHERE {shown}",
        "line_batches": f"WITH {labelled}, nb AS (SELECT *, ((row_number() OVER (PARTITION BY job_index ORDER BY line_index) - 1) // 5)::INT AS batch FROM ll WHERE {shown}) SELECT job_index, batch, count(*) AS n_lines, string_agg(text, chr(10) ORDER BY line_index) AS text FROM nb GROUP BY 1, 2",
        "quality_assessment": f"WITH {quality} SELECT * EXCLUDE (norm) FROM q",
        "quality_histogram": f"WITH {quality} SELECT status, count(*) AS n FROM q GROUP BY 1",
        "model_eligible": f"WITH {quality} SELECT job_index FROM q WHERE NOT (status IN ('truncated_or_broken', 'malformed') AND char_length < 40)",
        "candidate_rule_counts": f"WITH {labelled}, ml AS (SELECT * FROM ll WHERE NOT (boilerplate_label IN ('likely_legal', 'likely_benefits') AND length(text) < 200)) " + " UNION ALL ".join(f"SELECT '{name}' AS rule_source, sum(n)::BIGINT AS n_matches, count(*) FILTER (n > 0) AS n_lines FROM (SELECT len(regexp_extract_all(text, '{raw(p)}', 0, 'i')) AS n FROM ml)" for name, p in C.PATTERNS.items()),
        "mine_candidates": f"WITH {labelled_mc} SELECT * FROM mc",
        "candidates_per_line": f"WITH {labelled_mc} SELECT job_index, line_id, array_to_string(list_filter(o, lambda x, i: list_position(o, x) = i), '; ') AS hints FROM (SELECT job_index, line_id, list(candidate_text ORDER BY ordinal) AS o FROM mc GROUP BY 1, 2)",
        "rules_fired": f"WITH {stored_mc}, {fired} SELECT m.mention_id, coalesce({firsts}, '') AS rules_fired FROM m LEFT JOIN rf USING (mention_id) WHERE char_start >= 0",
        "ground_spans": f"WITH RECURSIVE {grounded} SELECT job_index, mention_idx, line_id, cs::INT AS char_start, (cs + length(span))::INT AS char_end, ok AS offset_valid FROM gw WHERE k > 0",
        "repair_offsets": f"""WITH {stored}, p0 AS (SELECT mention_id, skill_span AS span, source_line AS t, mention_idx % 4 AS turn, char_start - line_start AS own, evidence FROM m JOIN s1 USING (line_id)),
            p1 AS (SELECT *, CASE turn WHEN 0 THEN own WHEN 1 THEN own + 3 ELSE -1 END AS a, CASE WHEN turn = 2 AND {strip("coalesce(evidence, '')")} <> '' AND strpos(t, trim(evidence, ' ')) > 0 THEN strpos(t, trim(evidence, ' ')) - 1 END AS ev, CASE WHEN length(span) > 0 THEN list_filter(range(length(t)), lambda i: substring(t, i + 1, length(span)) = span) ELSE [] END AS spots FROM p0)
            SELECT mention_id, CASE WHEN turn < 2 AND a >= 0 AND length(span) > 0 AND substring(t, a + 1, length(span)) = span THEN a ELSE list_sort(list_transform(spots, lambda x: {{'d': abs(x - CASE WHEN a >= 0 THEN a ELSE coalesce(ev, 0) END), 'p': x}}))[1].p END::INT AS line_char_start FROM p1""",
        "line_chunks": f"WITH RECURSIVE {chunked} SELECT job_index, line_id, chunk FROM cw",
        "chunk_texts": f"WITH RECURSIVE {chunked}, cx AS (SELECT job_index, chunk, min(char_start) AS a, max(char_start + length(text)) AS b FROM cw JOIN l USING (job_index, line_id) GROUP BY 1, 2) SELECT job_index, chunk, substring(norm, a + 1, (b - a)::BIGINT) AS text FROM cx JOIN d USING (job_index)",
        "extract_stub": extracted(f"{described}, xs AS (SELECT job_index, description_raw AS text FROM d)", "job_index"),
        "extract_batches_stub": extracted(f"{labelled}, nb AS (SELECT *, ((row_number() OVER (PARTITION BY job_index ORDER BY line_index) - 1) // 5)::INT AS batch FROM ll WHERE {shown}), xs AS (SELECT job_index, batch, string_agg(text, chr(10) ORDER BY line_index) AS text FROM nb GROUP BY 1, 2)", "job_index, batch"),
        "verify_stub": verdict("verify", "is_skill", "HASH % 10 <> 0"),
        "requirement_stub": verdict("requirement", "requirement_level", "CASE sec WHEN 'requirements' THEN 'required' WHEN 'preferred' THEN 'optional' ELSE 'unclear' END"),
        "hardsoft_stub": verdict("hardsoft", "hard_soft", "CASE WHEN regexp_matches(span, '(?i)team|communicat|mentor|listen|negotiat|writing|adapt') THEN 'soft' ELSE 'hard' END"),
        "legacy_confidence": f"WITH {with_rules} SELECT mention_id, n_rules, final_confidence FROM f",
        "zero_mention_jobs": f"WITH {per_job} SELECT job_index FROM pj WHERE n = 0 ORDER BY job_index LIMIT 30",
        "transitions_apart": f"WITH RECURSIVE {apart_} SELECT tr.* FROM tr JOIN ka USING (model, kind, position)",
        "call_phases": f"WITH RECURSIVE {phased}, ph AS (SELECT pl.model, position, CASE WHEN cuts IS NULL OR position < cuts[1] THEN 1 WHEN len(cuts) = 2 AND position < cuts[2] THEN 2 ELSE 3 END AS phase FROM pl LEFT JOIN cu USING (model)) SELECT model, phase, count(*) AS calls, min(position) AS from_position FROM ph GROUP BY 1, 2",
        "reply_json": r"""WITH r AS (SELECT doc_id, regexp_replace(text, '(?is)^(\s*<think\b[^>]*>.*?</think>\s*)+', '') AS t FROM documents WHERE kind = 'reply'), f AS (SELECT doc_id, CASE WHEN regexp_matches(t, '(?is)```(?:json)?\s*(.*?)\s*```') AND regexp_extract(t, '(?is)```(?:json)?\s*(.*?)\s*```', 1) <> '' THEN regexp_extract(t, '(?is)```(?:json)?\s*(.*?)\s*```', 1) ELSE """ + strip("t") + r""" END AS t FROM r),
            o AS (SELECT doc_id, coalesce(nullif(regexp_extract(t, '(?s)[\[{].*[\]}]'), ''), t) AS t FROM f) SELECT doc_id, regexp_replace(t, ',\s*([\]}])', '\1', 'g') AS body FROM o""",
        "span_checks": f"WITH {merged} SELECT mention_id, offset_valid, evidence_ok FROM g",
        "resolve_lines": f"WITH {stored} SELECT mention_id, line_id, s1.line_section AS section, boilerplate_label, source_line FROM m JOIN s1 USING (line_id)",
        "merge_stages": f"WITH {merged} SELECT mention_id, is_skill, verifier_status, verifier_confidence, requirement_level, requirement_status, requirement_confidence, hard_soft, hardsoft_status, hardsoft_confidence FROM g",
        "final_confidence": f"WITH {conf} SELECT mention_id, final_confidence FROM f",
        "legacy_merge": f"WITH {mentions} SELECT mention_id, CASE WHEN {ran} THEN verifier_status <> 'rejected' ELSE coalesce(is_skill, true) END AS is_skill, CASE WHEN {ran} THEN verifier_status WHEN is_skill IS NOT NULL THEN 'extractor' ELSE 'skipped' END AS verifier_status FROM m",
        "needs_verifier": f"WITH {stored} SELECT mention_id, raw_model_confidence < 0.75 OR coalesce(hard_soft, 'unknown') = 'unknown' OR coalesce(requirement_level, 'unclear') = 'unclear' OR coalesce(boilerplate_label, 'uncertain') = 'uncertain' AS needed FROM m JOIN s1 USING (line_id)",
        "line_checks": "WITH s AS (SELECT DISTINCT * FROM parsed_lines), p AS (SELECT line_id, array_to_string(list_filter([CASE WHEN line_id IS NULL OR line_id = '' THEN 'no_id' END, CASE WHEN text IS NULL THEN 'no_text' END, CASE WHEN coalesce(char_start < 0 OR char_end - char_start <> length(text), true) THEN 'offsets' END], lambda x: x IS NOT NULL), ';') AS problems FROM s) SELECT * FROM p WHERE problems <> ''",
        "mention_checks": f"WITH {mentions}, t AS (SELECT job_index, any_value(description_normalized) AS t FROM preprocessed_descriptions GROUP BY 1), p AS (SELECT mention_id, array_to_string(list_filter([CASE WHEN t IS NULL THEN 'no_text' END, CASE WHEN coalesce(char_end <= char_start, true) THEN 'order' END, CASE WHEN coalesce(char_end > length(t), true) THEN 'beyond' END, CASE WHEN coalesce(substring(t, char_start + 1, char_end - char_start) <> skill_span, true) THEN 'span' END], lambda x: x IS NOT NULL), ';') AS problems FROM m LEFT JOIN t USING (job_index) WHERE char_start >= 0) SELECT * FROM p WHERE problems <> ''",
        "mention_numbers": f"WITH {merged} SELECT mention_id AS given_id, job_key || '_M' || lpad((row_number() OVER (PARTITION BY job_index ORDER BY mention_idx) - 1)::VARCHAR, 5, '0') AS mention_id FROM g",
        "stage_counters": f"WITH {merged} SELECT count(*) AS mentions, count(*) FILTER (is_skill) AS skills, count(*) FILTER (verifier_status = 'parse_failed') AS verifier_parse_failed, count(*) FILTER (verifier_status = 'rejected') AS verifier_rejected, count(*) FILTER (requirement_status = 'parse_failed') AS requirement_parse_failed, count(*) FILTER (hardsoft_status = 'parse_failed') AS hardsoft_parse_failed, count(*) FILTER (requirement_status = 'error') + count(*) FILTER (hardsoft_status = 'error') AS stage_errors FROM g",
        "run_totals": f"WITH {per_job} SELECT count(*) AS total_jobs, count(*) AS jobs_success, 0 AS jobs_failed, sum(n)::BIGINT AS total_mentions, count(*) FILTER (n = 0) AS zero_mention_jobs FROM pj",
        "resume_delta": "SELECT DISTINCT job_index FROM jobs WHERE job_index NOT IN (SELECT job_index FROM skill_mentions WHERE extractor_model = 'ext-large')",
        "retry_upsert": f"WITH {mentions}, u AS (SELECT * FROM m WHERE extractor_model = 'ext-small' UNION ALL SELECT * FROM m WHERE extractor_model = 'ext-large' AND job_index NOT IN (SELECT job_index FROM m WHERE extractor_model = 'ext-small')) SELECT extractor_model, count(*) AS n, count(DISTINCT job_index) AS jobs FROM u GROUP BY 1",
        "canonical_keys": f"WITH {canon} SELECT mention_id, canonical_key FROM k",
        "ontology_core": f"WITH {onto} SELECT canonical_key, job_count, mention_count, avg_confidence, type FROM o",
        "ontology_full": f"WITH {onto} SELECT canonical_skill, canonical_key, variants, type, type_distribution, requirement_level, requirement_distribution, job_count, mention_count, avg_confidence, confidence_min, confidence_max, common_contexts FROM o",
        "ontology_ranked": f"WITH {onto} SELECT row_number() OVER (ORDER BY job_count DESC, mention_count DESC, first_at) AS rank, canonical_key, job_count, mention_count FROM o",
        "ontology_csv": f"""WITH {onto} SELECT canonical_skill, canonical_key, variants, type, '{{"' || replace(replace(type_distribution, '=', '":'), ';', ',"') || '}}' AS type_distribution, requirement_level, '{{"' || replace(replace(requirement_distribution, '=', '":'), ';', ',"') || '}}' AS requirement_distribution,
            job_count, mention_count, avg_confidence, confidence_min::VARCHAR AS confidence_min, confidence_max::VARCHAR AS confidence_max, common_contexts, 'sf' AS run_id FROM o""",
        "duplicate_pairs": f"WITH {dup}",
        "title_skills": f"WITH {titles(False)} SELECT * FROM ts",
        "title_skills_mapped": f"WITH {titles(True)} SELECT title, canonical_key, points, posting_count, row_number() OVER (PARTITION BY title ORDER BY points DESC, canonical_key) AS rank FROM ts",
        "title_unmapped": f"WITH {mentions}, t AS (SELECT DISTINCT job_index, title_raw FROM m) SELECT count(*) AS n_jobs FROM t WHERE {strip(chr(39).join(['coalesce(title_raw, ', '', ')']))} NOT IN (SELECT normalized_title FROM title_reference UNION ALL SELECT '')",
        "skill_frequency": f"WITH {mentions} SELECT {name_lower} AS normalized_lower, count(*) AS n FROM m WHERE is_skill AND {name_lower} <> '' GROUP BY 1",
        "job_skills": f"WITH {mentions} SELECT job_id, coalesce(title_raw, '') AS title_norm, coalesce(nullif(normalized_candidate, ''), skill_span, '') AS normalized_skill, final_confidence, coalesce(hard_soft, '') AS hard_soft, coalesce(requirement_level, '') AS requirement_level FROM m WHERE is_skill",
        "low_confidence": f"WITH {mentions} SELECT mention_id, job_id, final_confidence, verifier_status FROM m WHERE coalesce(final_confidence, 1) < 0.55 OR coalesce(verifier_status = 'parse_failed', false)",
        "mentions_export": f"WITH {mentions} SELECT " + ", ".join(f"coalesce({c}::VARCHAR, '') AS {c}" if c in stored_columns else f"'' AS {c}" for c in MENTION_CSV) + " FROM m",
        "extraction_summary": f"WITH {per_job}, s AS (SELECT list_sort(list(n)) AS a FROM pj) SELECT count(*) AS total_jobs, sum(n)::BIGINT AS total_mentions, round(avg(n), 4) AS mean, median(n) AS median, min(n) AS min, max(n) AS max, count(*) FILTER (n = 0) AS zero_jobs, round(stddev_samp(n), 4) AS stdev, any_value(a[len(a) // 4 + 1]) AS q1, any_value(a[3 * len(a) // 4 + 1]) AS q3 FROM pj, s",
        "mention_classes": f"WITH {per_job} {classes('pj', 'n', R.MENTION_CLASSES)}",
        "confidence_histogram": f"WITH {mentions} SELECT CASE WHEN raw_model_confidence >= 1 THEN 10 ELSE floor(raw_model_confidence * 10)::INT END AS decile, count(*) AS n FROM m WHERE raw_model_confidence IS NOT NULL GROUP BY 1",
        "top_skills": f"WITH {mentions}, t AS (SELECT count(*) AS total FROM m WHERE normalized_candidate IS NOT NULL), c AS (SELECT normalized_candidate AS value, count(*) AS n FROM m WHERE normalized_candidate IS NOT NULL GROUP BY 1) SELECT value, n, {half_up('100 * n / total')} AS share, row_number() OVER (ORDER BY n DESC, value) AS rank FROM c, t QUALIFY rank <= 30",
        "field_frequency": f"WITH {mentions} " + " UNION ALL ".join(f"SELECT '{x}' AS field, count({x}) AS n_present, {half_up('100 * count(' + x + ') / greatest(count(*), 1)')} AS share FROM m" for x in fields),
        "verdict_distribution": f"WITH {mentions} " + " UNION ALL ".join(f"SELECT '{x}' AS field, coalesce({x}::VARCHAR, 'null') AS value, count(*) AS n FROM m GROUP BY 2" for x in kinds),
        "run_compare": f"WITH {cmp_} SELECT * FROM cp",
        "run_compare_summary": f"WITH {cmp_} SELECT count(*) FILTER (side = 'both') AS common, count(*) FILTER (side = 'only_a') AS only_a, count(*) FILTER (side = 'only_b') AS only_b, count(*) FILTER (difference = 0) AS equal, count(*) FILTER (difference > 0) AS b_more, count(*) FILTER (difference < 0) AS a_more, count(*) FILTER (n_a = 0 AND n_b = 0) AS zero_both, count(*) FILTER (n_a = 0 AND n_b > 0) AS zero_a_only, count(*) FILTER (n_b = 0 AND n_a > 0) AS zero_b_only, count(*) FILTER (difference <= -5) AS big_deficits, coalesce(-sum(difference) FILTER (difference <= -5), 0)::BIGINT AS deficit, count(*) FILTER (difference >= 5) AS big_surpluses, coalesce(sum(difference) FILTER (difference >= 5), 0)::BIGINT AS surplus, coalesce(sum(difference), 0)::BIGINT AS net FROM cp",
        "difference_classes": f"WITH {cmp_} {classes('(SELECT * FROM cp WHERE side = ' + chr(39) + 'both' + chr(39) + ')', 'difference', R.DIFFERENCE_CLASSES)}",
        "largest_differences": f"WITH {cmp_} SELECT * FROM cp WHERE side = 'both' ORDER BY abs(difference) DESC, job_index LIMIT 20",
        "topk_overlap": f"WITH {mentions} SELECT value, rank_a, rank_b, n_a, n_b, CASE WHEN rank_a IS NULL THEN 'only_b' WHEN rank_b IS NULL THEN 'only_a' ELSE 'both' END AS side FROM {top(needed, 100, 'a')} FULL JOIN {top('NOT ' + needed, 100, 'b')} USING (value)",
        "hourly_calls": f"WITH {calls} {stats(chr(39).join(['date_trunc(', 'hour', ', ts) AS hour']))}",
        "daily_calls": f"WITH {calls} {stats('ts::DATE AS day')}",
        "role_timing": f"WITH {calls} {stats('CASE WHEN role = ' + chr(39) + 'extractor' + chr(39) + ' THEN ' + chr(39) + 'extractor' + chr(39) + ' ELSE ' + chr(39) + 'verifier' + chr(39) + ' END AS bucket, model')}",
        "last_day_calls": f"WITH {calls}, z AS (SELECT * FROM c WHERE ts >= (SELECT max(ts) FROM c) - INTERVAL 24 HOUR) {stats('role', 'z')}",
        "last_100_calls": f"WITH {calls} SELECT call_id, ts, model FROM c ORDER BY ts DESC, call_id DESC LIMIT 100",
        "phase_transitions": f"WITH {trans} SELECT * FROM tr",
        "log_levels": "WITH v AS (SELECT unnest(string_split(text, chr(10))) AS value FROM documents WHERE kind = 'log') SELECT count(*) AS lines, count(*) FILTER (contains(value, 'WARN')) AS warnings, count(*) FILTER (contains(value, 'ERROR')) AS errors, count_if(contains(lower(value), 'timeout') OR contains(lower(value), 'timed out')) AS timeouts, count_if(contains(lower(value), 'retry')) AS retries FROM v",
    }
