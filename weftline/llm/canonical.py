"""Problem 2: freely typed values are mapped to the closest entry of a reference list; unmatched values are reported.

The reference entries stand in a trie, each by several paths: its name, its aliases, both with the words rotated
("matching, invoice") and with one word abbreviated ("Data Eng."). A value is cut into windows of consecutive words, since
grades, places or reference numbers may surround an entry, and each window is run through the trie as a Levenshtein automaton
(with transpositions): the automaton's states are bit sets, one per number of errors, and a trie edge advances the automata of
all windows of a batch at once. A branch is left as soon as no automaton on it is alive or could still end within the lengths below
it. Every entry within the distance its length allows is returned; the best covers most of the value with least errors. Windows longer
than a machine word have automata of unbounded integers, so entries of any length are found.

Each distinct value is searched once and joined back; a value on a third of all rows is combined map-side before, and
adaptive execution splits its share of the join. Values are hashed to blocks and entries to shards, and each pair of a block and a
shard is one group, a trie and the windows of its values: what a task holds is bounded whatever the lists' lengths, nothing is
broadcast or sent to the driver but two counts, and the best match over the shards wins.

Null and blank values are no values and match nothing. Texts of any length are handled whole.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.llm.common import require
from weftline.session import cut, spread

SHARD_ENTRIES, BLOCK_VALUES = 20_000, 2_000
WORD_BITS = 63  # longer windows have automata of unbounded integers

# A default of usual abbreviations that are no prefix of their word, or a very short one; others are the parameter ``abbreviations``.
ABBREVIATIONS = {
    "assistant": ("asst",),
    "associate": ("assoc",),
    "coordinator": ("coord",),
    "department": ("dept",),
    "director": ("dir",),
    "manager": ("mgr",),
    "officer": ("off", "ofc", "offr"),
    "operations": ("ops",),
    "operative": ("op",),
    "operator": ("op",),
    "registered": ("regd",),
    "supervisor": ("supv", "supvr"),
    "surveyor": ("svyr",),
    "technician": ("tech",),
    "teacher": ("tchr",),
}

_WORD = re.compile(r"[^\W_]+(?:[.+#]+(?=\s|$))?", re.UNICODE)


def words_of(value: str) -> list[str]:
    """Lower-case words, compatibility forms and apostrophes folded, signs between words dropped."""
    plain = unicodedata.normalize("NFKC", value).lower()
    plain = "".join(c for c in plain if unicodedata.category(c) != "Cf" and c not in "'’`")
    return [w.rstrip(".") for w in _WORD.findall(plain)]


def allowed(length: int) -> int:
    """Errors allowed for an entry path of so many characters: none up to 4, one up to 6, two up to 24, and one more for each further 24."""
    return 0 if length <= 4 else 1 if length <= 6 else 2 + (length - 1) // 24


def paths(names: Iterable[str], abbreviations: dict[str, tuple[str, ...]] = ABBREVIATIONS) -> dict[str, int]:
    """Path -> errors allowed, of the names of one entry."""
    out: dict[str, int] = {}
    for name in names:
        words = words_of(name or "")
        for k in range(len(words)):
            path = " ".join(words[k:] + words[:k])
            out[path] = max(out.get(path, 0), allowed(len(path)))
        if len(words) < 2:
            continue
        for i, word in enumerate(words):
            short = {word[:n] for n in range(3, len(word) - 2)} | set(abbreviations.get(word, ()))
            for s in short:
                out.setdefault(" ".join([*words[:i], s, *words[i + 1 :]]), 0)
    return out


class Trie:
    """Entry paths as a trie over which many Levenshtein automata walk together."""

    def __init__(self, entries: Iterable[tuple[int, list[str]]], abbreviations: dict[str, tuple[str, ...]] = ABBREVIATIONS):
        self.children: list[dict[str, int]] = [{}]
        self.ends: list[list[tuple[int, int, int]]] = [[]]  # (ref_id, errors allowed, path length)
        self.shortest, self.longest, self.most = [10**9], [0], [0]  # of the paths through a node: lengths, and errors allowed
        for ref_id, names in entries:
            for path, errors in paths(names, abbreviations).items():
                node = 0
                for c in (*path, None):
                    self.shortest[node] = min(self.shortest[node], len(path))
                    self.longest[node] = max(self.longest[node], len(path))
                    self.most[node] = max(self.most[node], errors)
                    if c is None:
                        self.ends[node].append((ref_id, errors, len(path)))
                        break
                    if c not in self.children[node]:
                        self.children[node][c] = len(self.children)
                        self.children.append({})
                        self.ends.append([])
                        self.shortest.append(10**9)
                        self.longest.append(0)
                        self.most.append(0)
                    node = self.children[node][c]
        self.alphabet = {c: i for i, c in enumerate(sorted({c for x in self.children for c in x}))}

    def search(self, windows: list[str]) -> list[tuple[int, int, int, int]]:
        """(window, ref_id, errors, path length) of every entry within its allowed distance of a window."""
        short = [i for i, w in enumerate(windows) if len(w) < WORD_BITS]
        long = [i for i, w in enumerate(windows) if len(w) >= WORD_BITS]
        return [(kept[q], *rest) for kept, exact in ((short, False), (long, True)) for q, *rest in self._walk([windows[i] for i in kept], exact)]

    def _walk(self, windows: list[str], unbounded: bool) -> list[tuple[int, int, int, int]]:
        import numpy as np

        found: list[tuple[int, int, int, int]] = []
        if not windows or not self.alphabet:
            return found
        n, kind = len(windows), object if unbounded else np.uint64
        one = 1 if unbounded else np.uint64(1)
        lengths = np.array([len(w) for w in windows], dtype=np.int64)
        masks = np.zeros((len(self.alphabet), n), dtype=kind)
        for q, w in enumerate(windows):
            for i, c in enumerate(w):
                a = self.alphabet.get(c)
                if a is not None:
                    masks[a, q] |= kind(1 << i) if not unbounded else 1 << i
        whole = (one << (lengths + 1).astype(kind)) - one
        final = one << lengths.astype(kind)
        k = self.most[0]
        start = [whole & np.full(n, (1 << (e + 1)) - 1, dtype=kind) for e in range(k + 1)]
        nothing = [np.zeros(n, dtype=kind) for _ in range(k)]
        stack = [(0, np.arange(n), start, nothing, None)]
        while stack:
            node, active, state, before, last = stack.pop()
            if self.ends[node]:
                hits = np.full(len(active), k + 1)
                for e in range(self.most[node], -1, -1):
                    hits[(state[e] & final[active]) != 0] = e
                for ref_id, errors, length in self.ends[node]:
                    for i in np.nonzero(hits <= errors)[0]:
                        found.append((int(active[i]), ref_id, int(hits[i]), length))
            for c, child in self.children[node].items():
                most = self.most[child]  # no path below allows more errors
                fits = (lengths[active] >= self.shortest[child] - most) & (lengths[active] <= self.longest[child] + most)
                mc, ends = masks[self.alphabet[c]][active], whole[active]
                new = [(state[0] & mc) << one]
                for e in range(1, most + 1):
                    x = ((state[e] & mc) << one) | state[e - 1] | (state[e - 1] << one) | (new[e - 1] << one)
                    if last is not None:
                        x = x | ((((before[e - 1] & mc) << one) & masks[last][active]) << one)
                    new.append(x & ends)
                alive = np.nonzero(fits & ((new[most] & ends) != 0))[0]
                if len(alive):
                    stack.append((child, active[alive], [x[alive] for x in new], [state[e][alive] for e in range(most)], self.alphabet[c]))
        return found


def windows_of(words: list[str], longest: int) -> Iterator[tuple[str, int]]:
    """(window, words in it) of consecutive words, no longer than an automaton can take."""
    for i in range(len(words)):
        text = ""
        for j in range(i, len(words)):
            text = f"{text} {words[j]}" if text else words[j]
            if len(text) > longest:
                break
            yield text, j - i + 1


MATCHES = "array<struct<ref_id: bigint, errors: int, covered: int>>"


def entries_of(reference: DataFrame, kind: str, name: str, alias: str | None = None) -> DataFrame:
    """``list, ref_id, names`` of a reference list; entries without an id or a name are none."""
    require(reference, "ref_id", name)
    names = F.array(F.col(name)) if alias is None else F.concat(F.array(F.col(name)), F.coalesce(F.col(alias), F.array().cast("array<string>")))
    kept = F.filter(names, lambda x: F.coalesce(x != "", F.lit(False)))
    return reference.where(F.col("ref_id").isNotNull()).select(F.lit(kind).alias("list"), F.col("ref_id").cast("bigint").alias("ref_id"), kept.alias("names")).where(F.size("names") > 0)


def search_group(values: list[str], entries: list[tuple[int, list[str]]], abbreviations: dict[str, tuple[str, ...]]) -> list[list[dict]]:
    """For each value all entries within their distance of one of its windows, by ref_id, each by its best path."""
    trie = Trie(entries, abbreviations)
    place: dict[str, list[int]] = {}
    for row, value in enumerate(values):
        for window, _ in windows_of(words_of(value), trie.longest[0] + trie.most[0]):
            place.setdefault(window, []).append(row)
    windows = list(place)
    best: list[dict[int, tuple[int, int]]] = [{} for _ in values]
    for at, ref_id, errors, length in trie.search(windows):
        for row in place[windows[at]]:
            old = best[row].get(ref_id)
            if old is None or (length - 3 * errors, -errors) > (old[1] - 3 * old[0], -old[0]):
                best[row][ref_id] = (errors, length)
    return [[{"ref_id": r, "errors": e, "covered": n} for r, (e, n) in sorted(x.items())] for x in best]


def match_values(values: DataFrame, entries: DataFrame, abbreviations: dict[str, tuple[str, ...]] | None = None, shard_entries: int = SHARD_ENTRIES, block_values: int = BLOCK_VALUES) -> DataFrame:
    """``list, value, matches, ref_id`` of distinct ``list, value``; ref_id is the best match's, -1 if there is none.

    Best is the entry covering most characters less three per error; ties go to fewer errors, then to the lower ref_id.
    """
    known = ABBREVIATIONS if abbreviations is None else abbreviations
    asked = cut(values.select("list", "value"))
    shards, blocks = (max(1, -(-df.count() // size)) for df, size in ((entries, shard_entries), (asked, block_values)))
    to = lambda n, *columns: F.pmod(F.xxhash64(*columns), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = asked.select("list", to(blocks, "list", "value").alias("block"), every(shards).alias("shard"), "value")
    right = entries.select("list", every(blocks).alias("block"), to(shards, "list", "ref_id").alias("shard"), "ref_id", "names")
    kind = pa.list_(pa.struct([("ref_id", pa.int64()), ("errors", pa.int32()), ("covered", pa.int32())]))

    def run(some: pa.Table, all_: pa.Table) -> pa.Table:
        given = [(r, [x for x in names if x]) for r, names in zip(all_.column("ref_id").to_pylist(), all_.column("names").to_pylist())]
        texts = some.column("value").to_pylist()
        found = search_group(texts, given, known) if texts else []
        return pa.table({"list": some.column("list"), "value": some.column("value"), "matches": pa.array(found, kind)})

    keys = ("list", "block", "shard")
    # few bytes but much work: the groups stay spread
    parts = spread(left, *keys).groupBy(*keys).cogroup(spread(right, *keys).groupBy(*keys)).applyInArrow(run, f"list string, value string, matches {MATCHES}")
    merged = parts.groupBy("list", "value").agg(F.flatten(F.collect_list("matches")).alias("matches"))
    ranked = F.array_max(F.transform("matches", lambda m: F.struct((m.covered - 3 * m.errors).alias("score"), (-m.errors).alias("few"), (-m.ref_id).alias("low"))))
    return merged.select("list", "value", "matches", F.coalesce(-ranked.low, F.lit(-1)).cast("bigint").alias("ref_id"))


def typed_values(mentions: DataFrame, jobs: DataFrame) -> DataFrame:
    """Long ``field, record_id, value`` of the typed values; blank ones left out."""
    both = mentions.select(F.lit("normalized_candidate").alias("field"), F.col("mention_id").alias("record_id"), F.col("normalized_candidate").alias("value")).unionByName(
        jobs.select(F.lit("title_raw").alias("field"), F.col("job_index").cast("string").alias("record_id"), F.col("title_raw").alias("value"))
    )
    return both.where(F.trim("value") != "")


def canonical_values(mentions: DataFrame, jobs: DataFrame, skills: DataFrame, titles: DataFrame, abbreviations: dict[str, tuple[str, ...]] | None = None) -> DataFrame:
    """``field, record_id, value, matches, ref_id`` of every typed value, rows distinct."""
    typed = typed_values(mentions, jobs).distinct()
    values = typed.groupBy(F.col("field").alias("list"), "value").agg(F.count("*").alias("n"))
    entries = entries_of(skills, "normalized_candidate", "canonical_skill", "aliases").unionByName(entries_of(titles, "title_raw", "normalized_title"))
    matched = match_values(values, entries, abbreviations).withColumnRenamed("list", "field")
    return typed.join(matched, ["field", "value"], "left").select("field", "record_id", "value", "matches", F.coalesce("ref_id", F.lit(-1)).cast("bigint").alias("ref_id"))


def mapped(canonical: DataFrame, skills: DataFrame, titles: DataFrame) -> DataFrame:
    """Distinct ``field, record_id, ref_id`` of the values that are not written as an entry of their list."""
    written = skills.select(F.lit("normalized_candidate").alias("field"), F.col("canonical_skill").alias("value")).unionByName(titles.select(F.lit("title_raw").alias("field"), F.col("normalized_title").alias("value")))
    return canonical.join(written.distinct(), ["field", "value"], "left_anti").select("field", "record_id", "ref_id").distinct()


def unmatched_report(canonical: DataFrame) -> DataFrame:
    """``field, value, n_records`` of the values that stand for no entry, by folded value."""
    folded = F.lower(F.trim("value"))
    return canonical.where(F.col("ref_id") == -1).groupBy("field", folded.alias("value")).agg(F.count_distinct("record_id").alias("n_records"))
