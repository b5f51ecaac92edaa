"""Problem 1: text that looks the same but differs in its characters is brought to one consistent form.

Arrow partitions are handed to an embedded DuckDB, whose SQL does the work on whole vectors: ``translate`` maps
compatibility characters one to one, a map holds those that expand, regular expressions remove invisible characters and
find words that mix scripts, ``nfc_normalize`` composes accents. There is no shuffle; a value is handled on its own.

The form, in this order:

1. every compatibility character becomes its plain counterpart (what NFKC does; DuckDB itself has only NFC),
2. every space separator becomes U+0020,
3. every format character (category Cf), and every other one without a sign (joiners of graphemes, fillers, inherent vowels), is removed,
4. base letters and combining accents are composed (NFC),
5. in a word that mixes Latin letters with look-alikes of another script, the look-alikes become Latin letters; where the
   word also has letters of that script that look like no Latin one, and all its Latin letters have a counterpart there,
   those become letters of that script instead.

Words wholly in one script, typographic quotes, dashes, bullets and currency signs stay. Null stays null, '' stays ''.
Texts of any length are handled whole. The form of a form is itself.
"""

from __future__ import annotations

import functools
import sys
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.llm.common import require

# Letters of other scripts and the Latin letters they look like.
LOOK_ALIKES = {
    "Cyrillic": (
        "АВЕКМНОРСТХУІЅЈҮԚԜаеорсхуіѕјһԁԛԝӏѵкг",
        "ABEKMHOPCTXYISJYQWaeopcxyisjhdqwlvkr",
    ),
    "Greek": (
        "ΑΒΕΖΗΙΚΜΝΟΡΤΥΧϹϳαγικνορυωϲ",
        "ABEZHIKMNOPTYXCjayikvopuwc",
    ),
    "Armenian": ("ՕՍոօսհց", "OUnouhg"),
    "Cherokee": ("ᎪᎠᏴᏟᎬᎢᎫᏞᎷᏢᏒᎡᏚᎳᏃ", "ADBCEIJLMPRRSWZ"),
}


# Invisible characters that Unicode doesn't count as format characters.
INVISIBLE = r"\x{34F}\x{115F}\x{1160}\x{17B4}\x{17B5}\x{3164}\x{FFA0}"


@functools.cache
def compatibility() -> tuple[dict[str, str], dict[str, str]]:
    """Characters whose compatibility form is one character, and those that expand or vanish; from Python's Unicode data."""
    single, several = {}, {}
    for i in range(0x80, sys.maxunicode + 1):
        c = chr(i)
        if 0xD800 <= i < 0xE000 or not unicodedata.decomposition(c).startswith("<"):
            continue
        plain = unicodedata.normalize("NFKC", c)
        plain = "".join(" " if unicodedata.category(x) == "Zs" else x for x in plain)
        if plain != c:
            (single if len(plain) == 1 else several)[c] = plain
    single["\u1680"] = " "  # the one space separator without a compatibility form
    single["\u2011"] = "-"  # the non-breaking hyphen looks like the hyphen that is typed
    return single, several


def quoted(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def char_class(chars) -> str:
    """An RE2 character class of ``chars``, with ranges."""
    runs: list[list[int]] = []
    for i in sorted(map(ord, chars)):
        if runs and runs[-1][1] == i - 1:
            runs[-1][1] = i
        else:
            runs.append([i, i])
    return "[" + "".join(rf"\x{{{a:x}}}" + (rf"-\x{{{b:x}}}" if b > a else "") for a, b in runs) + "]"


@functools.cache
def form_steps() -> list[tuple[str, str]]:
    """(name, SQL expression over the step before) of the embedded SQL; the first step reads column ``v``."""
    single, several = compatibility()
    expand = "MAP {" + ", ".join(f"{quoted(k)}: {quoted(x)}" for k, x in several.items()) + "}"
    steps = [
        ("a1", f"CASE WHEN regexp_matches(v, '{char_class(single)}') THEN translate(v, {quoted(''.join(single))}, {quoted(''.join(single.values()))}) ELSE v END"),
        ("a2", f"CASE WHEN regexp_matches(a1, '{char_class(several)}') THEN array_to_string(list_transform(string_split(a1, ''), lambda c: coalesce({expand}[c], c)), '') ELSE a1 END"),
        ("a3", rf"CASE WHEN regexp_matches(a2, '[\p{{Cf}}{INVISIBLE}]') THEN regexp_replace(a2, '[\p{{Cf}}{INVISIBLE}]', '', 'g') ELSE a2 END"),
        ("a4", "nfc_normalize(a3)"),
    ]
    last = "a4"
    for n, (script, (theirs, latin)) in enumerate(LOOK_ALIKES.items()):
        look = char_class(theirs)
        other = rf"[\p{{{script}}}]"
        to_latin = f"translate(w, {quoted(theirs)}, {quoted(latin)})"
        back = {y: x for x, y in zip(theirs, latin)}
        to_theirs = f"translate(w, {quoted(''.join(back))}, {quoted(''.join(back.values()))})"
        mixed = rf"regexp_matches(w, '\p{{Latin}}') AND regexp_matches(w, '{look}')"
        foreign = rf"regexp_matches(regexp_replace(w, '{look}', '', 'g'), '{other}') AND NOT regexp_matches(translate(w, {quoted(''.join(back))}, ''), '\p{{Latin}}')"
        word = f"CASE WHEN NOT ({mixed}) THEN w WHEN {foreign} THEN {to_theirs} ELSE {to_latin} END"
        some = rf"regexp_matches({last}, '\p{{Latin}}\p{{L}}*{look}|{look}\p{{L}}*\p{{Latin}}')"
        steps.append((f"b{n}", rf"CASE WHEN {some} THEN array_to_string(list_transform(regexp_extract_all({last}, '\p{{L}}+|\P{{L}}+'), lambda w: {word}), '') ELSE {last} END"))
        last = f"b{n}"
    steps.append(("form", f"nfc_normalize({last})"))
    return steps


def form_sql(source: str, value: str = "v", keep: str = "*") -> str:
    """SQL that adds column ``form`` to ``source``; ASCII values skip the work."""
    inner = f"SELECT {keep}, {value} AS v FROM {source} WHERE regexp_matches({value}, '[^\\x00-\\x7F]')"
    names = ["v"]
    for name, expression in form_steps():
        inner = f"SELECT * EXCLUDE ({names[-1]}), {expression} AS {name} FROM ({inner})" if names[-1] != "v" else f"SELECT *, {expression} AS {name} FROM ({inner})"
        names.append(name)
    return inner


def consistent_form(df: DataFrame, column: str, out: str = "consistent") -> DataFrame:
    """``df`` with the consistent form of string column ``column`` as column ``out`` (replaced if there is one).

    Rows keep their order within a partition; nulls and extra columns pass through.
    """
    require(df, column)
    if df.schema[column].dataType.simpleString() != "string":
        raise TypeError(f"{column} is no string column")
    rest = [c for c in df.columns if c != out]
    shaped = df.select(*[F.col(f"`{c}`") for c in rest], F.col(f"`{column}`").alias(out))
    at = len(rest)
    sql = f"SELECT k, form FROM ({form_sql('batch', 'value', 'k')})"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import duckdb
        import numpy as np
        import pyarrow.compute as pc

        con = duckdb.connect(config={"threads": 1, "memory_limit": "512MB"})
        for b in batches:
            values = b.column(at).cast(pa.string())
            con.register("batch", pa.table({"k": pa.array(np.arange(b.num_rows)), "value": values}))
            got = con.sql(sql).to_arrow_table()
            con.unregister("batch")
            if got.num_rows:
                k = got.column("k").to_numpy()
                mask = np.zeros(b.num_rows, dtype=bool)
                mask[k] = True
                fresh = got.column("form").combine_chunks().cast(pa.string()).take(pa.array(np.argsort(k, kind="stable")))
                values = pc.replace_with_mask(values, pa.array(mask), fresh)
            yield pa.RecordBatch.from_arrays([*b.columns[:at], values.cast(b.schema.field(at).type)], schema=b.schema)

    return shaped.mapInArrow(run, shaped.schema)


def consistent_fields(descriptions: DataFrame, mentions: DataFrame) -> DataFrame:
    """Both fields in consistent form, long: ``field, record_id, value, consistent``; a row of the inputs is a row here.

    ``record_id`` is job_index as decimal text or mention_id.
    """
    both = descriptions.select(F.lit("description_raw").alias("field"), F.col("job_index").cast("string").alias("record_id"), F.col("description_raw").alias("value")).unionByName(
        mentions.select(F.lit("skill_span").alias("field"), F.col("mention_id").alias("record_id"), F.col("skill_span").alias("value"))
    )
    return consistent_form(both, "value")


def inconsistent(descriptions: DataFrame, mentions: DataFrame) -> DataFrame:
    """Distinct ``field, record_id`` of the values that are not in the consistent form."""
    return consistent_fields(descriptions, mentions).where(F.col("value") != F.col("consistent")).select("field", "record_id").distinct()
