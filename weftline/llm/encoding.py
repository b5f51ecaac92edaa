"""Problem 10: text that was decoded with the wrong encoding is found and, where possible, restored.

Noisy-channel decoding. A channel is a pair (encoding the bytes were read as, encoding they were written in). Under a channel
a token goes back to a lattice of bytes: a character gives its bytes, a lost one (U+FFFD) the set of bytes that the reading encoding leaves
open, or all above ASCII where it leaves none. The lattice is read again in its own encoding; at an uncertain place stands a set of
characters, and what can't be read has no path. The words of a reading are searched among the corpus words that the lattice
admits: equal length, the kept characters at their places, the uncertain ones from their sets. The most frequent one is the path of
a word, and it fills the gaps only if the other words that fit are rare beside it; else the gap stays. Words of which less than half is kept are left as they are (a place of few choices counts for half of one).

A reading is weighed by how often its words occur in the distinct texts of the corpus, so
copies of a garbled text don't speak for it. Nor does the token's own text (texts are counted then, not occurrences), if more texts have the reading's words than its own
(at a tie: more copies) or if it is odd; what a sure channel reads counts for no correct word. Over the tokens of a document a Viterbi search picks the
channel of each: changing channels costs, so neighbouring tokens decide together and correct text stays as it is.

Nothing of corpus size is held anywhere: a text's tokens are taken once and written to the checkpoint folder; counts come from them by map-side combined
aggregates over distinct texts, each distinct token is read once, and damaged words meet the corpus words in an equi-join on length, place and kept
characters. The evidence meets the documents in another, broadcast only if its measured bytes are few. Per document only tokens with evidence are gathered.

Documents without an id are left out; several texts of one id are decided each for itself. Tokens are runs of ASCII letters, digits and non-ASCII characters that hold at least one of the latter; texts of any length
are read whole. Null and ASCII texts are no cases. Every U+FFFD is a lost character: its document is found even if no
word fits. Box drawings, rare signs and correct text in any script have better readings as they are.
"""

from __future__ import annotations

import functools
import itertools
import math
import re
import unicodedata
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftline.llm.common import require
from weftline.session import cut

LOST = "�"
# A run is entered at its start only and never given back, so a text is read once.
TOKEN = r"((?<![A-Za-z0-9\x{80}-\x{10FFFF}])[A-Za-z0-9]*+[^\x00-\x7F][A-Za-z0-9\x{80}-\x{10FFFF}]*+)"
UNIT = re.compile(r"[^\W\d_]+|[^\x00-\x7f]")

# Which encodings are taken for which; as read first, as written second.
UTF8_READ_AS = ("latin-1", "cp1252", "mac_roman", "cp437", "cp850", "cp1251", "cp1250", "koi8-r", "iso8859-2", "cp866")
BYTE_PAIRS = (
    ("cp1252", "cp1250"),
    ("latin-1", "iso8859-2"),
    ("cp1250", "cp1252"),
    ("cp1252", "cp1251"),
    ("latin-1", "koi8-r"),
    ("koi8-r", "cp1251"),
    ("cp1251", "koi8-r"),
    ("cp866", "cp1251"),
    ("cp1251", "cp866"),
    ("mac_roman", "cp1252"),
    ("cp1252", "mac_roman"),
    ("cp437", "cp1252"),
    ("cp1252", "cp437"),
    ("cp850", "cp1252"),
    ("cp1252", "cp850"),
)
SURE = ("utf-8 as latin-1", "utf-8 as cp1252")  # their byte sequences hardly occur in correct text
UNKNOWN = 0.05  # count of a word that the corpus doesn't have
STRANGER = 6.0  # further cost of such a word under the other channels, and of an odd token as it is
ENTER, LEAVE = 3.0, 1.0  # costs of leaving correct text for a channel, and of returning
BROADCAST_BYTES = 32 << 20  # of evidence; more is joined by shuffle
DOMINANT = 0.75  # the share that a word must have of the occurrences of all words that fit a gap
ANCHOR = 3  # characters of a damaged word that its corpus words are looked up by
ANY = frozenset(range(0x80, 0x100))


@functools.cache
def left_open(encoding: str) -> frozenset[int]:
    """The bytes for which an encoding has no character; all above ASCII where it has one for each."""
    return frozenset(b for b in ANY if bytes([b]).decode(encoding, "ignore") == "") or ANY


def to_bytes(text: str, encoding: str) -> list[int | frozenset[int]] | None:
    """The lattice of bytes that read as ``text``, a set at a lost place. None if there is none.

    Bytes that a Windows code page leaves open may come through as control characters, so those are taken back too.
    """
    out: list[int | frozenset[int]] = []
    for c in text:
        if c == LOST:
            out.append(left_open(encoding))
            continue
        try:
            out.extend(c.encode(encoding))
        except UnicodeError:
            if encoding.startswith("cp125") and 0x80 <= ord(c) < 0xA0:
                out.append(ord(c))
            else:
                return None
    return out


def sequences(data: list[int | frozenset[int]]) -> Iterator[list[int | frozenset[int]] | None]:
    """The UTF-8 sequences of a lattice, a list of byte places each; None where it can't go on."""
    i = 0
    while i < len(data):
        b = data[i]
        if isinstance(b, frozenset):  # an unknown lead byte owns what continues it
            n = 1
            while n < 4 and i + n < len(data) and isinstance(data[i + n], int) and 0x80 <= data[i + n] < 0xC0:
                n += 1
            leads = {1: b if b == ANY else frozenset(), 2: b & frozenset(range(0xC2, 0xE0)), 3: b & frozenset(range(0xE0, 0xF0)), 4: b & frozenset(range(0xF0, 0xF5))}[n]
            if not leads:
                yield None
                return
            yield [leads, *data[i + 1 : i + n]]
        else:
            n = 1 if b < 0x80 else 2 if 0xC2 <= b < 0xE0 else 3 if 0xE0 <= b < 0xF0 else 4 if 0xF0 <= b < 0xF5 else 0
            tail = [x & frozenset(range(0x80, 0xC0)) if isinstance(x, frozenset) else x for x in data[i + 1 : i + n]]
            if not n or len(tail) < n - 1 or any(not x if isinstance(x, frozenset) else not 0x80 <= x < 0xC0 for x in tail):
                yield None
                return
            yield [b, *tail]
        i += n


def from_lattice(data: list[int | frozenset[int]], encoding: str) -> tuple[str, list[str]] | None:
    """(text, choices) that a lattice of bytes reads as: LOST at an uncertain place, and for each in turn the characters it may be.

    '' among the choices is any character above ASCII. None if the lattice can't be read.
    """
    out, choices = [], []
    for places in sequences(data) if encoding == "utf-8" else ([b] for b in data):
        if places is None:
            return None
        sets = [p if isinstance(p, frozenset) else (p,) for p in places]
        if ANY in places and len(places) == 1 or math.prod(map(len, sets)) > 256:
            out.append(LOST)
            choices.append("")
            continue
        chars = {bytes(x).decode(encoding, "ignore") for x in itertools.product(*sets)} - {""}
        if not chars:
            return None
        out.append(chars.pop() if len(chars) == 1 else LOST)
        if out[-1] == LOST:
            choices.append("".join(sorted(chars)))
    return "".join(out), choices


def script(c: str) -> str:
    n = ord(c)
    if n < 0x250 or 0x1E00 <= n < 0x1F00:
        return "Latin"
    if 0x370 <= n < 0x400 or 0x1F00 <= n < 0x2000:
        return "Greek"
    if 0x400 <= n < 0x530:
        return "Cyrillic"
    return unicodedata.name(c, "unknown").split()[0]


def plausible(text: str) -> bool:
    """No control characters, and no word of letters of several scripts."""
    for c in text:
        if c != LOST and unicodedata.category(c) in ("Cc", "Cn", "Co", "Cs"):
            return False
    for w in UNIT.findall(text):
        if len(w) > 1 and len({script(c) for c in w if c != LOST and c.isalpha()}) > 1:
            return False
    return True


def high(data: list | None) -> bool:
    return data is not None and any(isinstance(x, frozenset) or x >= 0x80 for x in data)


def readings(token: str) -> list[tuple[str, str, list[str]]]:
    """(channel, reading, choices) of a token under every channel that has one and changes it.

    Lost characters alone speak for no channel.
    """
    out: dict[str, tuple[str, list[str]]] = {}
    if all(c == LOST or c < "\x80" for c in token):
        return []
    for wrong in UTF8_READ_AS:
        data = to_bytes(token, wrong)
        got = from_lattice(data, "utf-8") if high(data) else None
        if got is None or got[0] == token:
            continue
        if plausible(got[0]):
            out[f"utf-8 as {wrong}"] = got
        for again in ("latin-1", "cp1252"):  # read wrongly twice
            twice = to_bytes(got[0], again)
            more = from_lattice(twice, "utf-8") if high(twice) else None
            if more and more[0] != got[0] and plausible(more[0]):
                out[f"utf-8 as {wrong}"] = more
    for wrong, right in BYTE_PAIRS:
        data = to_bytes(token, wrong)
        got = None if data is None else from_lattice(data, right)
        if got and got[0] and got[0] != token and plausible(got[0]):
            out[f"{right} as {wrong}"] = got
    return sorted((k, *v) for k, v in out.items())


_WORDS = re.compile(rf"[^\W\d_]*{LOST}[^\W\d_{LOST}]*(?:{LOST}[^\W\d_]*)*|[^\W\d_]+|[^\x00-\x7f]")


def word_units(text: str, choices: list[str]) -> list[tuple[str, tuple | None, bool]]:
    """(unit, gap, capital) of a reading's words and single non-ASCII signs, lower-cased.

    A word with uncertain characters is one unit, named by the pattern of the words it may be; ``gap`` is then (length, place, characters there),
    by which those are looked up, the last two null if too little of it is kept.
    """
    out, left = [], iter(choices)
    for m in _WORDS.finditer(text):
        word = m[0].lower()
        if LOST not in word:
            out.append((word, None, m[0][0].isupper()))
            continue
        sets = [next(left, "").lower() if c == LOST else None for c in word]
        pattern = "".join(re.escape(c) if x is None else rf"[{re.escape(x)}]" if x else r"[^\x00-\x7f]" for c, x in zip(word, sets))
        runs = [(m.start(), m[0]) for m in re.finditer(f"[^{LOST}]+", word)]
        at, run = max(runs, key=lambda r: (min(len(r[1]), ANCHOR), -r[0]), default=(None, ""))
        kept, known = len(word) - word.count(LOST), sum(1 for x in sets if x)  # a place with few choices counts for half of a kept one
        enough = kept > 0 and 2 * kept + known >= len(word)
        out.append((f"^{pattern}$", (len(word), at if enough else None, run[:ANCHOR] if enough else None), False))
    return out


def foreign(documents: DataFrame) -> DataFrame:
    """``doc_id, version, text`` of the documents with an id and a non-ASCII character; ``version`` tells texts of one id apart."""
    require(documents, "doc_id", "text")
    some = documents.where(F.col("doc_id").isNotNull() & (F.octet_length("text") > F.char_length("text")))
    return some.select("doc_id", F.xxhash64("text").alias("version"), "text")


def tokened(documents: DataFrame) -> DataFrame:
    """``doc_id, version, h, tokens`` of ``foreign``: the non-ASCII tokens of each text in order; ``h`` are 128 bits of the text."""
    some = foreign(documents)
    return cut(some.select("doc_id", "version", F.struct("version", F.xxhash64(F.lit("text"), "text").alias("h2")).alias("h"), F.regexp_extract_all("text", F.lit(TOKEN), 1).alias("tokens")))


def token_counts(texts: DataFrame) -> DataFrame:
    """``token, n, t, m`` of each non-ASCII token: occurrences in distinct texts, distinct texts, and texts with their copies. Of a text's tokens that differ in case only, one counts for ``t`` and ``m``."""
    once = texts.groupBy("h").agg(F.first("tokens").alias("tokens"), F.count("*").alias("copies"))
    by_form = F.array_sort(F.transform("tokens", lambda t: F.struct(F.lower(t).alias("form"), t.alias("token"))))
    placed = once.select("copies", F.explode(F.array(by_form)).alias("f"))  # a generator, or the lambda below would sort the tokens again for each
    placed = placed.select("copies", F.transform("f", lambda x, i: F.struct(x.token.alias("token"), ((i == 0) | (F.get("f", i - 1).form != x.form)).alias("first"))).alias("f"))
    rows = placed.select("copies", F.explode("f").alias("x")).select("x.token", F.col("x.first").cast("bigint").alias("first"), "copies")
    return rows.groupBy("token").agg(F.count("*").alias("n"), F.sum("first").alias("t"), F.sum(F.col("first") * F.col("copies")).alias("m"))


UNITS = "token string, n bigint, t bigint, m bigint, channel string, reading string, i int, unit string, damaged boolean, size int, at int, gram string, doubtful boolean, odd boolean, capital boolean, suspect boolean, mere boolean"


def candidate_units(tokens: DataFrame) -> DataFrame:
    """UNITS: a row per unit of each reading and (channel '') of the token itself.

    doubtful: a sure channel can read the token, so its words say nothing for itself. suspect: any UTF-8 channel can, so its words are none to read or restore others by. odd: the token as it is has control
    characters or a word of several scripts. mere: signs, or what a UTF-8 channel can read, under a single-byte channel; they may belong to a passage but don't make one.
    """
    names = [c.split()[0] for c in UNITS.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for token, n, t, m in zip(*(b.column(c).to_pylist() for c in ("token", "n", "t", "m"))):
                others = readings(token)
                doubtful = any(channel in SURE for channel, _, _ in others)
                suspect = any(channel.startswith("utf-8") for channel, _, _ in others)
                signs = not any(c > "\x7f" and unicodedata.category(c)[0] in "LM" for c in token)
                for channel, text, choices in [("", token, []), *others]:
                    odd, mere = not channel and not plausible(text), (signs or suspect) and bool(channel) and not channel.startswith("utf-8")
                    for i, (u, gap, capital) in enumerate(word_units(text, choices) or [("", None, False)]):
                        rows.append((token, n, t, m, channel, text, i, u, gap is not None, *(gap or (None, None, None)), doubtful, odd, capital, suspect, mere))
            columns = list(zip(*rows)) or [()] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, _UNIT_KINDS)], names=names)

    return tokens.mapInArrow(run, UNITS)


_UNIT_KINDS = [{"string": pa.string(), "bigint": pa.int64(), "int": pa.int32(), "boolean": pa.bool_()}[c.split()[1]] for c in UNITS.split(", ")]


def fillings(exploded: DataFrame, counts: DataFrame) -> DataFrame:
    """``unit, word, wc, sure`` of the damaged units that corpus words fit: the most frequent one, and whether the others are rare beside it.

    A corpus word is offered by each place and run of up to ANCHOR characters, a damaged one looks up its longest: an equi-join, whose pairs the pattern checks.
    """
    words = counts.where((F.length("unit") > 1) & (F.octet_length("unit") > F.char_length("unit")) & (F.col("firm") > 0)).select(F.col("unit").alias("word"), F.col("firm").alias("wc"), F.length("unit").alias("size"), (2 * F.col("capitals") > F.col("c")).alias("capital"))
    runs = F.transform(F.sequence(F.lit(0), F.col("size") - 1), lambda i: F.transform(F.array(*[F.lit(g) for g in range(1, ANCHOR + 1)]), lambda g: F.struct(i.alias("at"), F.substr("word", i + 1, g).alias("gram"))))
    offered = words.select("word", "wc", "size", "capital", F.explode(F.array_distinct(F.flatten(runs))).alias("a")).select("word", "wc", "size", "capital", "a.at", "a.gram")
    broken = exploded.where(F.col("damaged") & F.col("gram").isNotNull()).select("unit", "size", "at", "gram").distinct()
    fitting = broken.join(offered, ["size", "at", "gram"]).where(F.rlike("word", F.col("unit")))
    best = fitting.groupBy("unit").agg(F.max(F.struct("wc", "word", "capital")).alias("w"), F.sum("wc").alias("all"))
    # a word that is mostly written with a capital offers it, for where its first letter is lost
    word = F.when(F.col("w.capital"), F.concat(F.upper(F.substring("w.word", 1, 1)), F.substring("w.word", 2, 10**9))).otherwise(F.col("w.word"))
    return best.select("unit", word.alias("word"), F.col("w.wc").alias("wc"), (F.col("w.wc") >= DOMINANT * F.col("all")).alias("sure"))


def evidence(texts: DataFrame) -> DataFrame:
    """``token, options, lost, own``: tokens that some channel reads better or about as well, with (channel, reading, gain) each.

    gain is the log-likelihood of the reading less that of the token as it is. Tokens with lost characters are always here; ``own`` is such a token
    with its gaps filled where a word is sure to fit.
    """
    exploded = cut(candidate_units(cut(token_counts(texts))))
    own = exploded.where((F.col("channel") == "") & ~F.col("damaged") & (F.col("unit") != ""))
    kinds = (("n", "clean", "doubtful"), ("t", "clean_texts", "doubtful"), ("n", "firm", "suspect"), ("t", "firm_texts", "suspect"))
    sure = [F.sum(F.when(~F.col(flag), F.col(x)).otherwise(0)).alias(y) for x, y, flag in kinds]
    counts = own.groupBy("unit").agg(F.sum("n").alias("c"), F.sum("t").alias("texts"), F.sum("m").alias("copied"), F.sum(F.when(F.col("capital"), F.col("n")).otherwise(0)).alias("capitals"), *sure)
    total = counts.agg(F.sum("c").cast("double").alias("total"), F.sum("copied").cast("double").alias("all_copies"))
    sized = exploded.drop("n", "t", "m", "size", "at", "gram").join(counts, "unit", "left").join(fillings(exploded, counts), "unit", "left").join(F.broadcast(total))
    as_read = F.col("channel") == ""

    def count(all_: str, clean: str, firm: str) -> Column:
        return F.coalesce(F.when(F.col("damaged"), F.col("wc")).when(~as_read | F.col("suspect"), F.col(firm)).when(F.col("doubtful"), F.col(clean)).otherwise(F.col(all_)), F.lit(0))

    known, texts_ = count("c", "clean", "firm"), count("texts", "clean_texts", "firm_texts")
    # the words that tell a token from its readings: of several letters, one of them not ASCII; signs and single letters are too common to
    telling = F.col("damaged") | ((F.length("unit") > 1) & (F.octet_length("unit") > F.char_length("unit")))
    eff = F.when(telling, texts_ + F.coalesce(F.when(~F.col("damaged"), F.col("copied")), F.lit(0)) / F.col("all_copies"))
    # a token's own text says nothing for it being correct
    others = F.when(as_read & ~F.col("damaged") & ~F.col("doubtful") & ~F.col("suspect"), F.greatest(texts_ - 1, F.lit(0))).otherwise(texts_)
    apart = F.when(telling, others).otherwise(known)
    stranger = F.when((known < 1) & (F.col("channel") != "") & ~F.col("channel").isin(*SURE) & (F.length("unit") > 0), F.lit(STRANGER)).otherwise(0.0)

    def weight(of: Column) -> Column:
        return F.sum(F.when(F.col("unit") == "", 0.0).otherwise(F.log((of + UNKNOWN) / F.col("total")) - stranger))

    filled = F.collect_list(F.when(F.col("sure"), F.struct("i", "word")))
    scored = sized.groupBy("token", "channel", "reading").agg(weight(apart).alias("score"), weight(known).alias("whole"), F.min(eff).alias("least"), F.max(eff).alias("most"), F.max("damaged").alias("damaged"), F.max("odd").alias("odd"), F.max("mere").alias("mere"), filled.alias("words"))
    strange = F.when(F.col("odd"), STRANGER).otherwise(0.0)
    as_is = scored.where("channel = ''").select("token", (F.col("score") - strange).alias("base"), (F.col("whole") - strange).alias("whole_base"), F.col("most").alias("own_most"), "odd", F.col("damaged").alias("lost"), F.col("words").alias("own"))
    against = scored.where("channel != ''").join(as_is.select("token", "base", "whole_base", "own_most", F.col("odd").alias("own_odd")), "token")
    gains = against.withColumn("gain", F.when(F.col("own_odd") | (F.col("least") > F.col("own_most")), F.col("score") - F.col("base")).otherwise(F.col("whole") - F.col("whole_base")))
    gains = gains.withColumn("gain", F.when(F.col("mere"), F.least("gain", F.lit(0.0))).otherwise(F.col("gain")))
    hopeful = gains.where(F.col("gain") > -2.0).groupBy("token").agg(F.collect_list(F.struct("channel", "reading", "gain", "words")).alias("options"))
    return hopeful.join(as_is.where("lost").select("token", "lost", "own"), "token", "full").select("token", F.coalesce("options", F.array()).alias("options"), F.coalesce("lost", F.lit(False)).alias("lost"), F.coalesce("own", F.array()).alias("own"))


def complete(reading: str, words: list) -> str:
    """A reading with the gaps of its i-th words filled from the corpus words for them; kept characters stay as they are."""
    by_place = {w["i"]: w["word"] for w in words}
    if not by_place:
        return reading
    place = itertools.count()

    def one(m: re.Match) -> str:
        word = by_place.get(next(place))
        if word is None or len(word) != len(m[0]):
            return m[0]
        kept = m[0].replace(LOST, "")
        loud = len(kept) > 1 and kept.isupper()
        if not loud and m[0][0] == LOST and m[0][1:2].isupper():
            return m[0]  # what is lost stood before the word
        return "".join(c if c != LOST else w.upper() if loud else w for c, w in zip(m[0], word))

    return _WORDS.sub(one, reading)


def viterbi(steps: list[dict[str, float]]) -> list[str]:
    """The best channel ('' is correct text) of each step, from the gains of its channels; '' always gains 0.

    Each step keeps where it came from, so the work grows with the steps. A channel survives a token it has no reading for only through correct text.
    """
    def cost(old: str, to: str) -> float:
        return 0.0 if old == to else LEAVE if to == "" else ENTER if old == "" else ENTER + LEAVE

    scores, came = {"": 0.0}, []
    for gains in steps:
        best = {to: max(((scores[old] - cost(old, to), old) for old in scores)) for to in ("", *gains)}
        scores = {to: score + gains.get(to, 0.0) for to, (score, _) in best.items()}
        came.append({to: old for to, (_, old) in best.items()})
    path = [max(scores, key=lambda c: (scores[c], c))] if steps else []
    for back in reversed(came[1:]):
        path.append(back[path[-1]])
    return path[::-1]


DECISIONS = "doc_id bigint, version bigint, n_tokens int, n_garbled int, n_lost int, fixes array<struct<pos: int, reading: string, channel: string>>"


def decide(documents: DataFrame) -> DataFrame:
    """``doc_id, version, n_tokens, n_garbled, n_lost, fixes`` of the documents with garbled or lost tokens; ``pos`` counts a text's tokens."""
    texts = tokened(documents)
    found = cut(evidence(texts))
    size = F.octet_length("token") + F.lit(64) + F.aggregate("options", F.lit(0).cast("bigint"), lambda acc, o: acc + F.octet_length(o["reading"]) + F.octet_length(o["channel"]) + 48 + 48 * F.size(o["words"]))
    if (found.agg(F.sum(size).alias("bytes")).first().bytes or 0) <= BROADCAST_BYTES:
        found = F.broadcast(found)
    placed = texts.select("doc_id", "version", F.posexplode("tokens").alias("pos", "token"))
    met = placed.join(found, "token").groupBy("doc_id", "version").agg(F.collect_list(F.struct("pos", "token", "options", "lost", "own")).alias("steps"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for doc_id, version, steps in zip(*(b.column(c).to_pylist() for c in ("doc_id", "version", "steps"))):
                by_pos = {s["pos"]: s for s in steps}  # equal rows of one id are one
                steps = [by_pos[k] for k in sorted(by_pos)]
                path = viterbi([{o["channel"]: o["gain"] for o in s["options"]} for s in steps])
                fixes, garbled, lost = [], 0, 0
                for s, channel in zip(steps, path):
                    if channel:
                        o = next(o for o in s["options"] if o["channel"] == channel)
                        garbled += 1
                        fixes.append({"pos": s["pos"], "reading": complete(o["reading"], o["words"]), "channel": channel})
                    elif s["lost"]:
                        lost += 1
                        new = complete(s["token"], s["own"])
                        if new != s["token"]:
                            fixes.append({"pos": s["pos"], "reading": new, "channel": "lost"})
                if garbled or lost:
                    rows.append((doc_id, version, len(steps), garbled, lost, fixes))
            columns = list(zip(*rows)) or [()] * len(_DECISION_KINDS)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, _DECISION_KINDS)], names=[c.split()[0] for c in DECISIONS.split(", ", 5)])

    return met.mapInArrow(run, DECISIONS)


_DECISION_KINDS = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.list_(pa.struct([("pos", pa.int32()), ("reading", pa.string()), ("channel", pa.string())]))]


def restore(documents: DataFrame) -> DataFrame:
    """``doc_id, restored_text, n_garbled, n_lost, complete`` of the affected documents; complete if no U+FFFD is left."""
    fixes = decide(documents)
    # only affected texts are compared; equal rows of one id are one
    joined = foreign(documents).join(fixes, ["doc_id", "version"]).dropDuplicates(["doc_id", "version"])
    token = re.compile(r"(?<![A-Za-z0-9\x80-\U0010FFFF])[A-Za-z0-9]*+[^\x00-\x7F][A-Za-z0-9\x80-\U0010FFFF]*+")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            texts = []
            for text, fix in zip(b["text"], b["fixes"]):
                by_pos = {f["pos"]: f["reading"] for f in fix}
                out, at = [], 0
                for pos, m in enumerate(token.finditer(text)):
                    if pos in by_pos:
                        out += [text[at : m.start()], by_pos[pos]]
                        at = m.end()
                texts.append("".join([*out, text[at:]]))
            yield pd.DataFrame({"doc_id": b["doc_id"], "restored_text": texts, "n_garbled": b["n_garbled"], "n_lost": b["n_lost"], "complete": [LOST not in t for t in texts]})

    return joined.mapInPandas(run, "doc_id bigint, restored_text string, n_garbled int, n_lost int, complete boolean")


def garbled(documents: DataFrame) -> DataFrame:
    """Distinct ``doc_id`` of the documents with at least one garbled passage."""
    return decide(documents).select("doc_id").distinct()
