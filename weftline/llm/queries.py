"""The queries of this subpackage and their SQL, over the tables of a data folder."""

from __future__ import annotations

import sys
import unicodedata
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.llm import canonical, consistent_form, cooccurrence, distinctive_terms, encoding, markup, mixing, packing, page_difference, repeated_lines, term_frequency
from weftline.session import cut, table

Query = Callable[[SparkSession, str], DataFrame]


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return consistent_form.inconsistent(table(spark, d, "preprocessed_descriptions"), table(spark, d, "skill_mentions"))


def p1_consistent(spark: SparkSession, d: str) -> DataFrame:
    fields = consistent_form.consistent_fields(table(spark, d, "preprocessed_descriptions"), table(spark, d, "skill_mentions"))
    return fields.select("field", "record_id", "consistent").distinct()


def _canonical(spark: SparkSession, d: str) -> DataFrame:
    return canonical.canonical_values(*(table(spark, d, n) for n in ("skill_mentions", "jobs", "skill_reference", "title_reference")))


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return canonical.mapped(_canonical(spark, d), table(spark, d, "skill_reference"), table(spark, d, "title_reference"))


def p2_mapped(spark: SparkSession, d: str) -> DataFrame:
    return _canonical(spark, d).select("field", "record_id", "value", "ref_id", F.size("matches").alias("n_matches"))


def p2_unmatched(spark: SparkSession, d: str) -> DataFrame:
    return canonical.unmatched_report(_canonical(spark, d))


def _recurring(spark: SparkSession, d: str) -> DataFrame:
    """Lines that recur over clusters of copies and publication days."""
    return repeated_lines.repeated_lines(table(spark, d, "parsed_lines"), table(spark, d, "jobs"), min_days=2)


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    """Postings are counted by clusters of copies, each with its number of postings. Days can't decide here: the test tables define a case by postings alone."""
    lines = table(spark, d, "parsed_lines")
    return repeated_lines.repeated_line_rows(lines, repeated_lines.repeated_lines(lines, by="postings")).select("line_id").distinct()


def p3_line_counts(spark: SparkSession, d: str) -> DataFrame:
    counts = repeated_lines.named(table(spark, d, "parsed_lines"), _recurring(spark, d))
    return counts.select("source", "letters", "n_clusters", "n_postings", "n_days", "source_clusters", "source_postings")


def p3_without(spark: SparkSession, d: str) -> DataFrame:
    """Without the lines that recur over clusters and days; those of one republished article stay."""
    return repeated_lines.without_repeated(table(spark, d, "parsed_lines"), _recurring(spark, d)).select("line_id", "job_index", "source", "text", "line_index").distinct()


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return markup.marked_up(table(spark, d, "preprocessed_descriptions"))


def p4_clean(spark: SparkSession, d: str) -> DataFrame:
    return markup.clean_descriptions(table(spark, d, "preprocessed_descriptions"))


def p4_differences(spark: SparkSession, d: str) -> DataFrame:
    """The method named: postings as pages of their site, at a path made of employer and title."""
    path = F.concat_ws("/", F.lower("employer"), F.lower(F.coalesce("title_raw", "job_title")))
    pages = table(spark, d, "jobs").select("job_index", F.col("source").alias("host"), path.alias("path"), F.coalesce("description_raw", "job_description").alias("text"))
    return page_difference.page_differences(pages).select("job_index", "host", "path", "text", "difference")


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return term_frequency.mention_terms(table(spark, d, "skill_mentions")).where(F.col("mark").isNotNull()).select("field", "term", "mark")


def p5_counts(spark: SparkSession, d: str) -> DataFrame:
    return term_frequency.mention_terms(table(spark, d, "skill_mentions")).select("field", "term", "n_rows", "n_records", "mark")


def _pairs(spark: SparkSession, d: str) -> DataFrame:
    return cooccurrence.cooccurrence(table(spark, d, "skill_mentions"), "job_id", "normalized_candidate")


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    exact = F.col("n_both") * F.col("n_baskets") >= cooccurrence.MIN_LIFT * F.col("n_a") * F.col("n_b")
    return _pairs(spark, d).where(exact).select(F.col("a").alias("skill_a"), F.col("b").alias("skill_b"))


def p6_pairs(spark: SparkSession, d: str) -> DataFrame:
    return _pairs(spark, d).select(F.col("a").alias("skill_a"), F.col("b").alias("skill_b"), "n_a", "n_b", "n_both", "n_baskets", F.round("lift", 6).alias("lift"), F.round("pmi", 6).alias("pmi"))


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    return distinctive_terms.distinctive(distinctive_terms.posting_terms(table(spark, d, "skill_mentions"), table(spark, d, "jobs")))


def p7_scores(spark: SparkSession, d: str) -> DataFrame:
    scores = distinctive_terms.posting_terms(table(spark, d, "skill_mentions"), table(spark, d, "jobs"))
    return scores.select("field", F.col("record").alias("job_index"), "term", "y", "n_record", "n_collection", "n_records", F.round("z", 6).alias("z"))


def p8_packed(spark: SparkSession, d: str) -> DataFrame:
    return packing.pack_documents(table(spark, d, "documents"), table(spark, d, "pack_capacity"))


def p8_usage(spark: SparkSession, d: str) -> DataFrame:
    return packing.usage(p8_packed(spark, d))


def p9_selection(spark: SparkSession, d: str) -> DataFrame:
    return mixing.mix(table(spark, d, "documents"), table(spark, d, "mix_targets"))[0]


def p9_shares(spark: SparkSession, d: str) -> DataFrame:
    return mixing.mix(table(spark, d, "documents"), table(spark, d, "mix_targets"))[1]


def p10_found(spark: SparkSession, d: str) -> DataFrame:
    return encoding.garbled(table(spark, d, "documents"))


def p10_restored(spark: SparkSession, d: str) -> DataFrame:
    return encoding.restore(table(spark, d, "documents"))


def queries() -> dict[str, Query]:
    return {f.__name__: f for f in (p1_found, p1_consistent, p2_found, p2_mapped, p2_unmatched, p3_found, p3_line_counts, p3_without, p4_found, p4_clean, p4_differences, p5_found, p5_counts, p6_found, p6_pairs, p7_found, p7_scores, p8_packed, p8_usage, p9_selection, p9_shares, p10_found, p10_restored)}


def _folded(column: str) -> str:
    return f"lower(trim({column}, ' '))"


def _plain_forms() -> dict[str, str]:
    """Characters that the consistent form replaces by others or by none, whatever stands beside them: compatibility forms, spaces, invisible ones."""
    out = {}
    for c in map(chr, (i for i in range(0x80, sys.maxunicode + 1) if not 0xD800 <= i < 0xE000)):
        plain = unicodedata.normalize("NFKC", c) if unicodedata.decomposition(c).startswith("<") else c
        kept = [" " if unicodedata.category(x) == "Zs" else x for x in plain if unicodedata.category(x) != "Cf" and x not in INVISIBLE]
        if "".join(kept) != c:
            out[c] = "".join(kept)
    return out | {"\u2011": "-"}


# Characters without a sign of their own that Unicode doesn't count as format characters.
INVISIBLE = "\u034f\u115f\u1160\u17b4\u17b5\u3164\uffa0"


def _unmixed(source: str) -> str:
    """SQL over ``source`` (v, w, i), w a run of letters or of others: Latin where it mixes Latin letters with look-alikes, or the other script where only that can be meant."""
    for script, (theirs, latin) in consistent_form.LOOK_ALIKES.items():
        back = {y: x for x, y in zip(theirs, latin)}
        keys, values = "".join(back), "".join(back.values())
        mixed = rf"regexp_matches(w, '\p{{Latin}}') AND regexp_matches(w, '[{theirs}]')"
        owns = rf"regexp_matches(regexp_replace(w, '[{theirs}]', '', 'g'), '\p{{{script}}}') AND NOT regexp_matches(translate(w, '{keys}', ''), '\p{{Latin}}')"
        source = f"(SELECT v, i, CASE WHEN {mixed} AND {owns} THEN translate(w, '{keys}', '{values}') WHEN {mixed} THEN translate(w, '{theirs}', '{latin}') ELSE w END AS w FROM {source})"
    return source


def oracle_sql() -> dict[str, str]:
    """DuckDB SQL, written from the problem statements; operators that SQL can't state are tested by brute force instead."""
    fields = "SELECT 'description_raw' AS field, CAST(job_index AS VARCHAR) AS record_id, description_raw AS v FROM preprocessed_descriptions UNION ALL SELECT 'skill_span', mention_id, skill_span FROM skill_mentions"
    # each character meets its plain form in a table made from Unicode data, and the characters are put together again
    plain = ", ".join(f"({chr(39)}{c}{chr(39)}, {chr(39)}{x.replace(chr(39), chr(39) * 2)}{chr(39)})" for c, x in _plain_forms().items())
    form_all = rf"""WITH fields AS ({fields}), pf(c, x) AS (VALUES {plain}), vs AS (SELECT DISTINCT v FROM fields WHERE regexp_matches(v, '[^\x00-\x7F]')), ch AS (SELECT v, unnest(string_split(v, '')) AS c, generate_subscripts(string_split(v, ''), 1) AS i FROM vs),
        a AS (SELECT v, nfc_normalize(string_agg(coalesce(x, ch.c), '' ORDER BY i)) AS t FROM ch LEFT JOIN pf USING (c) GROUP BY v),
        ws AS (SELECT v, unnest(regexp_extract_all(t, '\p{{L}}+|\P{{L}}+')) AS w, generate_subscripts(regexp_extract_all(t, '\p{{L}}+|\P{{L}}+'), 1) AS i FROM a),
        fm AS (SELECT v, nfc_normalize(string_agg(w, '' ORDER BY i)) AS form FROM {_unmixed('ws')} GROUP BY v)"""
    letters = r"regexp_replace(lower(text), '[^\p{L}]', '', 'g')"
    lines = rf"""l AS (SELECT *, {letters} AS k, len(regexp_extract_all(text, '\p{{L}}+')) AS w FROM parsed_lines WHERE source IS NOT NULL AND text IS NOT NULL),
        n AS (SELECT source, count(DISTINCT job_index) AS n FROM l GROUP BY 1), c AS (SELECT source, k, count(DISTINCT job_index) AS c FROM l WHERE w >= 5 GROUP BY 1, 2),
        notice AS (SELECT source, k FROM c JOIN n USING (source) WHERE c >= 3 AND c * 10 >= n)"""
    recurring = """day AS (SELECT job_index, min(posted_at)::DATE AS day FROM jobs WHERE job_index IS NOT NULL GROUP BY 1), u AS (SELECT DISTINCT source, job_index, k FROM l WHERE w >= 5 AND job_index IS NOT NULL),
        cl AS (SELECT p.source, p.job_index, coalesce(string_agg(k, '|' ORDER BY k), '') AS cl FROM (SELECT DISTINCT source, job_index FROM l WHERE job_index IS NOT NULL) p LEFT JOIN u ON u.source = p.source AND u.job_index = p.job_index GROUP BY 1, 2),
        sc AS (SELECT source, count(DISTINCT cl) AS source_clusters, count(*) AS source_postings FROM cl GROUP BY 1), kc AS (SELECT source, k, count(DISTINCT cl) AS n_clusters, count(*) AS n_postings, count(DISTINCT day) AS n_days FROM u JOIN cl USING (source, job_index) LEFT JOIN day USING (job_index) GROUP BY 1, 2),
        rec AS (SELECT * FROM kc JOIN sc USING (source) WHERE n_clusters >= 3 AND n_clusters * 10 >= source_clusters AND n_days >= 2)"""
    terms = f"""once AS (SELECT DISTINCT mention_id, job_index, normalized_candidate, skill_span FROM skill_mentions),
        f AS (SELECT 'normalized_candidate' AS field, {_folded('normalized_candidate')} AS term, job_index FROM once UNION ALL SELECT 'skill_span', {_folded('skill_span')}, job_index FROM once),
        c AS (SELECT field, term, count(*) AS n_rows, count(DISTINCT job_index) AS n_records FROM f WHERE term <> '' AND job_index IS NOT NULL GROUP BY 1, 2), n AS (SELECT count(DISTINCT job_index) AS n FROM skill_mentions),
        m AS (SELECT field, term, n_rows, n_records, CASE WHEN n_records < 3 THEN 'rare' WHEN n_records > 0.08 * n THEN 'common' END AS mark FROM c, n)"""
    pairs = f"""b AS (SELECT DISTINCT job_id, {_folded('normalized_candidate')} AS t FROM skill_mentions WHERE job_id IS NOT NULL AND {_folded('normalized_candidate')} <> ''),
        m AS (SELECT t, count(*) AS a FROM b GROUP BY 1), n AS (SELECT count(DISTINCT job_id) AS n_baskets FROM b), c AS (SELECT x.t AS a, y.t AS b, count(*) AS c FROM b x JOIN b y ON x.job_id = y.job_id AND x.t < y.t GROUP BY 1, 2),
        p AS (SELECT c.a AS skill_a, c.b AS skill_b, m1.a AS n_a, m2.a AS n_b, c.c AS n_both, n_baskets FROM c JOIN m m1 ON m1.t = c.a JOIN m m2 ON m2.t = c.b, n WHERE c.c >= 5)"""
    scored = rf"""r AS (SELECT DISTINCT 'normalized_candidate' AS field, job_index, {_folded('normalized_candidate')} AS term, mention_id FROM skill_mentions WHERE job_index IS NOT NULL AND mention_id IS NOT NULL AND {_folded('normalized_candidate')} <> ''),
        t AS (SELECT DISTINCT job_index, title_raw FROM jobs WHERE job_index IS NOT NULL AND title_raw IS NOT NULL), w AS (SELECT job_index, unnest(list_distinct(regexp_extract_all(lower(title_raw), '\p{{L}}+'))) AS term FROM t),
        y AS (SELECT field, job_index, term, count(*) AS y FROM r GROUP BY ALL UNION ALL SELECT 'title_raw', job_index, term, count(*) FROM w GROUP BY ALL),
        s AS (SELECT field, job_index, term, y, sum(y) OVER (PARTITION BY field, job_index) AS n_record, sum(y) OVER (PARTITION BY field, term) AS n_collection, count(*) OVER (PARTITION BY field, term) AS n_records, sum(y) OVER (PARTITION BY field) AS n_all FROM y),
        bound AS (SELECT 'normalized_candidate' AS field, greatest(4, count(DISTINCT job_index) // 100) AS most FROM skill_mentions UNION ALL SELECT 'title_raw', greatest(4, count(DISTINCT job_index) // 100) FROM jobs WHERE trim(title_raw, ' ') <> '')"""
    prior = "n_collection * 500.0 / n_all"
    z = f"""(ln((y + {prior}) / greatest(n_record + 500.0 - y - {prior}, 1)) - ln((n_collection - y + {prior}) / greatest(n_all - n_record + 500.0 - (n_collection - y) - {prior}, 1))) / sqrt(1 / (y + {prior}) + 1 / (n_collection - y + {prior}))"""
    return {
        "p1_found": f"{form_all} SELECT DISTINCT field, record_id FROM fields LEFT JOIN fm USING (v) WHERE v <> coalesce(form, CASE WHEN regexp_matches(v, '[^\\x00-\\x7F]') THEN '' ELSE v END)",
        "p1_consistent": f"{form_all} SELECT DISTINCT field, record_id, coalesce(form, CASE WHEN regexp_matches(v, '[^\\x00-\\x7F]') THEN '' ELSE v END) AS consistent FROM fields LEFT JOIN fm USING (v)",
        "p3_found": f"WITH {lines} SELECT DISTINCT line_id FROM l JOIN notice USING (source, k) WHERE w >= 5",
        "p3_line_counts": f"WITH {lines}, {recurring} SELECT source, k AS letters, n_clusters, n_postings, n_days, source_clusters, source_postings FROM rec",
        "p3_without": rf"WITH {lines}, {recurring} SELECT DISTINCT line_id, job_index, source, text, line_index FROM (SELECT p.*, {letters} AS k, len(regexp_extract_all(text, '\p{{L}}+')) AS w FROM parsed_lines p) q WHERE NOT coalesce(w >= 5 AND EXISTS (SELECT 1 FROM rec WHERE rec.source = q.source AND rec.k = q.k), false)",
        "p5_found": f"WITH {terms} SELECT field, term, mark FROM m WHERE mark IS NOT NULL",
        "p5_counts": f"WITH {terms} SELECT field, term, n_rows, n_records, mark FROM m",
        "p6_found": f"WITH {pairs} SELECT skill_a, skill_b FROM p WHERE n_both * n_baskets >= 3 * n_a * n_b",
        "p6_pairs": f"WITH {pairs} SELECT skill_a, skill_b, n_a, n_b, n_both, n_baskets, round(n_both * n_baskets / (n_a::DOUBLE * n_b), 6) AS lift, round(log2(n_both * n_baskets / (n_a::DOUBLE * n_b)), 6) AS pmi FROM p",
        "p7_found": f"WITH {scored} SELECT DISTINCT field, job_index, term FROM s JOIN bound USING (field) WHERE n_records BETWEEN 2 AND most AND ((field = 'normalized_candidate' AND y >= 3) OR (field = 'title_raw' AND length(term) >= 4))",
        "p7_scores": f"WITH {scored} SELECT field, job_index, term, y, n_record::BIGINT AS n_record, n_collection::BIGINT AS n_collection, n_records, round({z}, 6) AS z FROM s",
    }
