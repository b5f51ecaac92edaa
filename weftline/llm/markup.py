"""Problem 4: HTML, Markdown, wiki and LaTeX residue becomes clean text that keeps its structure.

The method named for this problem (pages paired by nearest URL path within a host, lines common to both deleted) is the operator
of ``page_difference``; it can't give the result asked for, as markup isn't what two pages share: the README has its figures on these tables.
For the problem's queries it is replaced by parsing: each text is read by the four grammars, which record what they removed and what the removed marks meant.

A filter of the JVM's regular expressions, a superset of all marks, flags the texts with a suspicious sign; only those
are parsed, in Arrow batches of one pass over the table. There is no shuffle.

Structure in the result: a heading is a line of its own, a list item a line behind a bullet or its number, code keeps its
lines and indentation, a formula its TeX source without the delimiters; ``blocks`` names the kind, level and text of each.
Clean text has no markup any more, except what code and formulas hold: cleaning it again changes nothing else.

Null gives null, '' gives ''. Whole texts are read, of whatever length.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftline.llm.common import require

# Superset of every construct below; lines of plain text rarely match it.
SUSPECT = r"(?m)</?[A-Za-z]|<!--|&#?[A-Za-z0-9]+;|\*\*|__|`|~~|\[\[|\{\{|''|^\s*={1,6}[^=]+=|^\s*#{1,6}\s|^\s*>|^\s*[-=]{3,}\s*$|\|\s*:?-{3}|\]\(|\\[A-Za-z\\\[\](){}&%$#_]|\$[^$\n]+\$|(?<![\w*])\*[^\s*]|(?<!\w)_[^\s_]|\[(?:https?:)?//|\$\$|<[!?]|^\s*[*#]{2,}|^\s*:?-{3,}:?\s*\|"

# The elements that HTML defines and that postings use.
TAGS = (
    "a abbr address article aside b bdi bdo big blockquote body br button caption center cite code col colgroup dd del details dfn div dl dt em "
    "figcaption figure font footer form h1 h2 h3 h4 h5 h6 head header hr html i iframe img input ins kbd label legend li link main mark meta nav "
    "ol option p picture pre q s samp script section select small source span strike strong style sub summary sup svg table tbody td textarea tfoot "
    "th thead time title tr tt u ul var video wbr"
).split()
_ATTR = r"""(?:\s+[A-Za-z_:][\w:.-]*\s*=\s*(?:"[^"]*"|'[^']*'|[^\s"'<>=`]+)|\s+(?:hidden|disabled|checked|selected|required|readonly|itemscope|nowrap))*"""
TAG = re.compile(rf"</?({'|'.join(sorted(TAGS, key=len, reverse=True))}){_ATTR}\s*/?>", re.I)
ANY_TAG = re.compile(rf"</?[A-Za-z][\w:-]*{_ATTR}\s*/?>")
COMMENT = re.compile(r"<!--.*?(?:-->|\Z)|<!DOCTYPE[^>]*>|<\?xml[^>]*\?>", re.S | re.I)
ENTITY = re.compile(r"&(?:#\d{1,7}|#[xX][0-9A-Fa-f]{1,6}|[A-Za-z][A-Za-z0-9]{1,31});")
ESCAPED_TAG = re.compile(rf"&lt;(?:/?(?:{'|'.join(TAGS)})\b|!--)", re.I)

MD_HEADING = re.compile(r"^[ \t]{0,8}(#{1,6})[ \t]+(?!\d+\b[^\n]{0,3}$)(\S[^\n]*?)[ \t]*#*[ \t]*$", re.M)
UNDERLINE = re.compile(r"^[ \t]*(-{3,}|={3,})[ \t]*$")
FENCE = re.compile(r"^[ \t]*(```+|~~~+)[ \t]*[\w+-]*[ \t]*$")
QUOTE = re.compile(r"^[ \t]*>[ \t]*(?=[^\s\d=<>])")
TABLE_RULE = re.compile(r"^[ \t]*\|?[ \t]*:?-{3,}:?[ \t]*(?:\|[ \t]*:?-{3,}:?[ \t]*)*\|?[ \t]*$")
MD_LINK = re.compile(r"!?\[([^\[\]\n]*)\]\(([^()\s]*)(?:[ \t]+\"[^\"\n]*\")?\)")
# Names that the Python language writes between double underscores; they are no emphasis.
DUNDER = "init main name repr str call len iter next enter exit new del eq hash getitem setitem dict doc file all version slots class".split()
BOLD = re.compile(r"(?<![*\w])\*\*(?=\S)([^*\n]+?)(?<=\S)\*\*(?!\*)|(?<!\w)__(?!(?:" + "|".join(DUNDER) + r")__)(?=\S)([^_\n]+?)(?<=\S)__(?!\w)")
ITALIC = re.compile(r"(?<![*\w\\])\*(?=[^\s*])([^*\n]+?)(?<=[^\s*])\*(?![*\w])|(?<![\w\\])_(?=[^\s_])([^_\n]+?)(?<=[^\s_])_(?!\w)")
STRIKE = re.compile(r"~~(?=\S)([^~\n]+?)(?<=\S)~~")
CODE = re.compile(r"(?<!`)(`+)(?!`)([^`\n]+?)\1(?!`)")

WIKI_HEADING = re.compile(r"^[ \t]*(={2,6})[ \t]*([^=\n]+?)[ \t]*\1[ \t]*$")
WIKI_QUOTES = re.compile(r"'''''([^'\n]+(?:'(?!')[^'\n]+)*)'''''|'''([^'\n]+(?:'(?!')[^'\n]+)*)'''|(?<!')''([^'\n]+(?:'(?!')[^'\n]+)*)''(?!')")
WIKI_LINK = re.compile(r"\[\[([^\[\]|\n]*)(?:\|([^\[\]\n]*))?\]\]")
WIKI_TEMPLATE = re.compile(r"\{\{[^{}]*\}\}")
WIKI_EXTERNAL = re.compile(r"\[(?:https?:)?//\S+?(?:[ \t]+([^\]\n]*))?\]")
WIKI_LIST = re.compile(r"^[ \t]*(\*{2,6}|[*#]{2,6})(?=[ \t]+\S)")
WIKI_TABLE = re.compile(r"^[ \t]*(?:\{\|[^\n]*|\|\}|\|-+[^\n]*)$")
WIKI_TAGS = re.compile(r"<(ref|nowiki|references|gallery|math|syntaxhighlight|source|poem)\b[^<>]*?(?:/>|>)|</(ref|nowiki|references|gallery|math|syntaxhighlight|source|poem)\s*>", re.I)

TEX_HEADING = re.compile(r"\\(part|chapter|section|subsection|subsubsection|paragraph|subparagraph)\*?\s*\{([^{}\n]*)\}")
TEX_BEGIN_END = re.compile(r"\\(begin|end)\s*\{([A-Za-z]+\*?)\}(?:\[[^\]\n]*\])?")
TEX_COMMAND = re.compile(r"\\[A-Za-z]{2,}\*?(?=[\s{\[\\]|$)|\\(?:item)\b", re.M)
TEX_ARGUMENT = re.compile(r"\\([A-Za-z]+)\*?(?:\[[^\]\n]*\])?\{([^{}]*)\}")
TEX_BREAK = re.compile(r"[ \t]*\\\\(?:\[[^\]\n]*\])?[ \t]*$", re.M)
TEX_SIGN = re.compile(r"\\([&%$#_{}])")
TEX_MATH = re.compile(r"\$\$(.+?)\$\$|\\\[(.+?)\\\]|\\\((.+?)\\\)|(?<![\\$\w])\$(?=[^\s$\d])([^$\n]*?[\\^_=+{}][^$\n]*?)(?<=[^\s$])\$(?![\d$])", re.S)
MATH_ENVIRONMENTS = ("equation", "align", "gather", "multline", "displaymath", "math", "eqnarray")

BLOCKS = "array<struct<kind: string, level: int, text: string>>"
# Private-use stand-ins for what later rules must not read: code and formulas.
_OPEN, _CLOSE = "\ue000", "\ue001"
_HEAD, _ITEM, _BREAK = "\ue002", "\ue003", "\ue004"
_BREAKS = re.compile(f"[ \\t]*\\n?[ \\t]*(?:{_BREAK}[ \\t]*\\n?[ \\t]*)+")
_SCRIPT = re.compile(r"<(script|style)\b[^>]*>.*?</\1\s*>", re.S | re.I)
_PRE = re.compile(rf"<pre{_ATTR}\s*>(.*?)</pre\s*>", re.S | re.I)
_CODE = re.compile(rf"<code{_ATTR}\s*>(.*?)</code\s*>", re.S | re.I)
_H = re.compile(rf"<h([1-6]){_ATTR}\s*>(.*?)</h\1\s*>", re.S | re.I)
_NAME = re.compile(r"</?([A-Za-z][\w:-]*)")
_NOWIKI = re.compile(r"<nowiki\s*>(.*?)</nowiki\s*>", re.S | re.I)
_SYNTAX = re.compile(r"<(syntaxhighlight|source)\b[^<>]*>\n?(.*?)</\1\s*>", re.S | re.I)
_MATH = re.compile(r"<math\b[^<>]*>(.*?)</math\s*>", re.S | re.I)
_REF = re.compile(r"<ref\b[^<>]*?/>|<ref\b[^<>]*>.*?</ref\s*>", re.S | re.I)
_CATEGORY = re.compile(r"\[\[(?:Category|Kategorie|File|Image|Datei)\s*:[^\[\]\n]*\]\]", re.I)
_VERBATIM = re.compile(r"\\begin\{(verbatim|lstlisting|minted)\*?\}(?:\[[^\]\n]*\])?(?:\{\w+\})?\n?(.*?)\s*\\end\{\1\*?\}", re.S)
_ENVIRONMENT = re.compile(r"\\begin\{((?:" + "|".join(MATH_ENVIRONMENTS) + r")\*?)\}(.*?)\\end\{\1\}", re.S)
_LISTS = re.compile(r"\\begin\s*\{([A-Za-z]+\*?)\}(?:\[[^\]\n]*\])?|\\end\s*\{([A-Za-z]+\*?)\}|\\item\b(?:\[[^\]\n]*\])?[ \t]*")
_SPACING = re.compile(r"\\(?:par|noindent|centering|bigskip|medskip|smallskip|newline|hfill|quad|qquad|maketitle|newpage|clearpage|small|large|bfseries|itshape|normalsize|footnotesize)\b[ \t]*")
_KNOWN = frozenset(TAGS)
_BLOCK_TAGS = frozenset("p div tr table section article header footer blockquote hr dl dt dd form main aside nav body html head title address figure tbody thead".split())


def template(m: re.Match) -> str:
    """A template's text: its name where it has no arguments, else their values."""
    name, *arguments = m[0][2:-2].split("|")
    return " ".join(a.split("=", 1)[-1].strip() for a in arguments) if arguments else name.strip()


class _Reader:
    """One text on its way through the grammars."""

    def __init__(self, text: str):
        self.text, self.kinds, self.kept = text, set(), []

    def keep(self, kind: str, text: str, block: bool) -> str:
        self.kept.append((kind, text))
        mark = f"{_OPEN}{len(self.kept) - 1}{_CLOSE}"
        return f"\n{mark}\n" if block else mark

    def sub(self, kind: str, pattern: re.Pattern, to) -> None:
        self.text, n = pattern.subn(to, self.text)
        if n:
            self.kinds.add(kind)

    # --- HTML -------------------------------------------------------------------------------------------------------
    def html(self) -> None:
        if "<" not in self.text and "&" not in self.text:
            return
        if ESCAPED_TAG.search(self.text):
            self.kinds.add("html")
            self.text = ENTITY.sub(lambda m: html.unescape(m[0]) if m[0].lower() in ("&lt;", "&gt;", "&quot;", "&#39;", "&amp;") else m[0], self.text)
        self.sub("html", COMMENT, "")
        self.sub("html", _SCRIPT, "")

        def pre(m: re.Match) -> str:
            inner = TAG.sub("", m[1])
            return self.keep("code", html.unescape(inner).strip("\n"), True)

        self.sub("html", _PRE, pre)
        self.sub("html", _CODE, lambda m: self.keep("code", html.unescape(TAG.sub("", m[1])), "\n" in m[1]))
        self.sub("html", _H, lambda m: f"{_BREAK}{_HEAD}{m[1]}{' '.join(TAG.sub('', m[2]).split())}{_BREAK}")
        self._tags()
        self.text = _BREAKS.sub("\n", self.text)

    def _tags(self) -> None:
        out, at, lists = [], 0, []
        for m in ANY_TAG.finditer(self.text):
            name = _NAME.match(m[0])[1].lower()
            if name not in _KNOWN and ("=" not in m[0] or WIKI_TAGS.fullmatch(m[0])):
                continue  # the wiki's own elements are read later; an unknown word in angle brackets is text
            self.kinds.add("html")
            out.append(self.text[at : m.start()])
            at = m.end()
            closing = m[0][1] == "/"
            if name in ("ul", "ol"):
                if not closing:
                    lists.append([name, 0])
                elif lists:
                    lists.pop()
                out.append(_BREAK)
            elif name == "li":
                if closing:
                    out.append(_BREAK)
                    continue
                sign = "• "
                if lists and lists[-1][0] == "ol":
                    lists[-1][1] += 1
                    sign = f"{lists[-1][1]}. "
                out.append(f"{_BREAK}{_ITEM}{min(9, max(1, len(lists)))}{sign}")
            elif name in ("td", "th"):
                out.append("" if closing else " | ")
            elif name == "br" or name in _BLOCK_TAGS:
                out.append(_BREAK)
        out.append(self.text[at:])
        self.text = "".join(out)

    def entities(self) -> None:
        def one(m: re.Match) -> str:
            got = html.unescape(m[0])
            if got == m[0]:
                return got
            self.kinds.add("html")
            return " " if got == "\xa0" else got

        while "&" in self.text:  # each pass shortens the text, here and below
            new = ENTITY.sub(one, self.text)
            if new == self.text:
                break
            self.text = new

    # --- LaTeX ------------------------------------------------------------------------------------------------------
    def latex(self) -> None:
        if "\\" not in self.text and "$" not in self.text:
            return
        self.sub("latex", _VERBATIM, lambda m: self.keep("code", m[2].rstrip(), True))
        self.sub("latex", _ENVIRONMENT, lambda m: self.keep("formula", m[2].strip(), True))
        self.sub("latex", TEX_MATH, lambda m: self.keep("formula", next(x for x in m.groups() if x is not None).strip(), m[0].startswith(("$$", "\\["))))
        is_tex = bool(TEX_HEADING.search(self.text) or TEX_BEGIN_END.search(self.text) or TEX_ARGUMENT.search(self.text) or re.search(r"\\item\b", self.text))
        is_tex = is_tex or bool(TEX_BREAK.search(self.text)) or "latex" in self.kinds
        if not is_tex and not TEX_SIGN.search(self.text):
            return
        self.kinds.add("latex")
        levels = {"part": 1, "chapter": 1, "section": 1, "subsection": 2, "subsubsection": 3, "paragraph": 4, "subparagraph": 5}
        self.text = TEX_HEADING.sub(lambda m: f"\n{_HEAD}{levels[m[1]]}{m[2].strip()}\n", self.text)
        out, at, lists = [], 0, []
        for m in _LISTS.finditer(self.text):
            out.append(self.text[at : m.start()])
            at = m.end()
            if m[1]:
                lists.append([m[1], 0])
            elif m[2]:
                if lists:
                    lists.pop()
            else:
                ordered = lists and lists[-1][0].startswith("enumerate")
                if ordered:
                    lists[-1][1] += 1
                out.append(f"{_ITEM}{max(1, len(lists))}" + (f"{lists[-1][1]}. " if ordered else "• "))
        self.text = "".join([*out, self.text[at:]])
        while True:
            new = TEX_ARGUMENT.sub(lambda m: f"{m[2]}" if m[1] not in ("label", "ref", "cite", "vspace", "hspace", "usepackage", "documentclass", "includegraphics", "pagestyle", "input") else "", self.text)
            if new == self.text:
                break
            self.text = new
        self.text = TEX_BREAK.sub("", self.text)
        self.text = _SPACING.sub("", self.text)
        self.text = TEX_SIGN.sub(r"\1", self.text)
        self.text = re.sub(r"(?<=\S)~(?=\S)", " ", self.text)

    # --- wiki -------------------------------------------------------------------------------------------------------
    def wiki(self) -> None:
        if not any(x in self.text for x in ("<", "{{", "[", "''")):
            return
        self.sub("wiki", _NOWIKI, lambda m: self.keep("code", m[1], False))
        self.sub("wiki", _SYNTAX, lambda m: self.keep("code", m[2].rstrip(), True))
        self.sub("wiki", _MATH, lambda m: self.keep("formula", m[1].strip(), False))
        self.sub("wiki", _REF, "")
        self.sub("wiki", WIKI_TAGS, "")
        while True:  # templates nest
            before = self.text
            self.sub("wiki", WIKI_TEMPLATE, template)
            if before == self.text:
                break
        self.sub("wiki", _CATEGORY, "")
        self.sub("wiki", WIKI_LINK, lambda m: m[2] if m[2] is not None and m[2].strip() else m[1])
        self.sub("wiki", WIKI_EXTERNAL, lambda m: m[1] or "")
        self.sub("wiki", WIKI_QUOTES, lambda m: next(x for x in m.groups() if x is not None))

    # --- lines: Markdown, wiki headings and lists ----------------------------------------------------------------------
    def lines(self) -> None:
        rows, out, i = self.text.split("\n"), [], 0
        wiki = "wiki" in self.kinds or any(WIKI_HEADING.match(x) for x in rows)
        while i < len(rows):
            row = rows[i].rstrip("\r")
            if FENCE.match(row):
                sign = FENCE.match(row)[1]
                end = next((j for j in range(i + 1, len(rows)) if rows[j].strip().startswith(sign) and not rows[j].strip().strip(sign[0])), None)
                if end is not None:
                    self.kinds.add("markdown")
                    self.kept.append(("code", "\n".join(x.rstrip("\r") for x in rows[i + 1 : end])))
                    out.append(f"{_OPEN}{len(self.kept) - 1}{_CLOSE}")
                    i = end + 1
                    continue
            if m := WIKI_HEADING.match(row):
                self.kinds.add("wiki")
                out.append(f"{_HEAD}{min(6, len(m[1]))}{m[2]}")
            elif (m := UNDERLINE.match(row)) and out and out[-1].strip() and out[-1][0] not in (_HEAD, _ITEM, _OPEN) and not UNDERLINE.match(out[-1]):
                self.kinds.add("markdown")
                out[-1] = f"{_HEAD}{1 if m[1][0] == '=' else 2}{out[-1].strip()}"
            elif "|" in row and TABLE_RULE.match(row):
                self.kinds.add("markdown")
            elif wiki and WIKI_TABLE.match(row):
                self.kinds.add("wiki")
            elif (m := WIKI_LIST.match(row)) and (wiki or m[1].strip("#")):
                self.kinds.add("wiki")
                out.append(f"{_ITEM}{len(m[1])}• {row[m.end() :].strip()}")
            elif wiki and (m := re.match(r"[ \t]*#[ \t]*(?=\S)", row)):
                out.append(f"{_ITEM}1• {row[m.end() :].strip()}")
            elif m := MD_HEADING.match(row):
                self.kinds.add("markdown")
                out.append(f"{_HEAD}{len(m[1])}{m[2]}")
            elif m := QUOTE.match(row):
                self.kinds.add("markdown")
                out.append(row[m.end() :])
            else:
                out.append(row)
            i += 1
        self.text = "\n".join(out)

    def inline(self) -> None:
        self.sub("markdown", MD_LINK, lambda m: m[1])
        self.sub("markdown", CODE, lambda m: self.keep("code", m[2], False))
        for pattern in (BOLD, ITALIC, STRIKE):
            while True:
                before = self.text
                self.sub("markdown", pattern, lambda m: next(x for x in m.groups() if x is not None))
                if before == self.text:
                    break

    # --- result -----------------------------------------------------------------------------------------------------
    def result(self) -> tuple[str, list[dict]]:
        restore = re.compile(f"{_OPEN}(\\d+){_CLOSE}")
        lines, blocks = [], []
        for row in self.text.split("\n"):
            whole = restore.fullmatch(row.strip())
            if whole:
                kind, text = self.kept[int(whole[1])]
                blocks.append({"kind": kind, "level": 0, "text": text})
                lines.extend(text.split("\n"))
                continue
            for m in restore.finditer(row):
                blocks.append({"kind": self.kept[int(m[1])][0], "level": 0, "text": self.kept[int(m[1])][1]})
            row = restore.sub(lambda m: self.kept[int(m[1])][1], row)
            if row[:1] in (_HEAD, _ITEM):
                kind, level, row = ("heading" if row[0] == _HEAD else "list_item"), int(row[1]), row[2:].strip()
                blocks.append({"kind": kind, "level": level, "text": row.removeprefix("• ") if kind == "list_item" else row})
            else:
                row = row.replace(_HEAD, "").replace(_ITEM, "")
                if m := re.match(r"[ \t]*(?:[•*+-]|\d{1,3}[.)])[ \t]+(\S.*)", row):
                    blocks.append({"kind": "list_item", "level": 1, "text": m[1].strip()})
                elif row.strip():
                    blocks.append({"kind": "paragraph", "level": 0, "text": row.strip()})
            lines.append(row.rstrip())
        text = re.sub(r"\n{3,}", "\n\n", "\n".join(lines)).strip("\n")
        return text, blocks


def read_markup(text: str | None) -> tuple[str | None, list[str], list[dict]]:
    """(clean text, grammars that had marks in it, blocks); a text without marks comes back as it is."""
    if not text:
        return text, [], []
    source = text.replace("\r\n", "\n").replace("\r", "\n")
    for c in (_OPEN, _CLOSE, _HEAD, _ITEM, _BREAK):
        source = source.replace(c, "")
    r = _Reader(source)
    r.html()
    r.wiki()
    r.latex()
    r.lines()
    r.inline()
    r.entities()
    clean, blocks = r.result()
    if not r.kinds:
        return text, [], blocks
    return clean, sorted(r.kinds), blocks


def _parsed(df: DataFrame, column: str, out: str, suspicious: Column) -> DataFrame:
    """``clean_markup``, of the rows that are ``suspicious``; the others' texts come out as they are."""
    kinds, blocks = f"{out}_kinds", f"{out}_blocks"
    rest = [c for c in df.columns if c not in (out, kinds, blocks)]
    named = [F.col(f"`{c}`") for c in rest]
    empty = [F.array().cast("array<string>").alias(kinds), F.array().cast(BLOCKS).alias(blocks)]
    flagged = df.select(*named, F.col(f"`{column}`").alias(out), *empty, F.coalesce(suspicious, F.lit(False)).alias("_suspicious"))
    shaped = flagged.drop("_suspicious").schema
    at = len(rest)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            types = [b.schema.field(at + i).type for i in range(3)]
            got = [read_markup(t.as_py()) if flag else (t, [], []) for t, flag in zip(b.column(at), b.column(at + 3).to_pylist())]
            texts = pa.array([t.as_py() if isinstance(t, pa.Scalar) else t for t, _, _ in got], types[0])
            yield pa.RecordBatch.from_arrays([*b.columns[:at], texts, *[pa.array([g[i] for g in got], types[i]) for i in (1, 2)]], names=b.schema.names[: at + 3])

    return flagged.mapInArrow(run, shaped)


def clean_markup(df: DataFrame, column: str, out: str = "clean_text") -> DataFrame:
    """``df`` with ``out``, ``<out>_kinds`` (grammars found, empty if none) and ``<out>_blocks``; other columns pass through. Texts without marks have no blocks."""
    require(df, column)
    return _parsed(df, column, out, F.col(f"`{column}`").rlike(SUSPECT))


def clean_descriptions(descriptions: DataFrame) -> DataFrame:
    """``job_index, field, clean_text, kinds, blocks`` of both description fields; a row of the table gives a row each."""
    both = descriptions.select("job_index", F.explode(F.array(*[F.struct(F.lit(c).alias("field"), F.col(c).alias("text")) for c in ("description_raw", "description_normalized")])).alias("e")).select("job_index", "e.field", "e.text")
    return clean_markup(both, "text").select("job_index", "field", "clean_text", F.col("clean_text_kinds").alias("kinds"), F.col("clean_text_blocks").alias("blocks"))


def marked_up(descriptions: DataFrame) -> DataFrame:
    """Distinct ``job_index`` of the postings whose description_raw holds markup."""
    suspects = descriptions.select("job_index", "description_raw").where(F.col("description_raw").rlike(SUSPECT))
    return _parsed(suspects, "description_raw", "clean_text", F.lit(True)).where(F.size("clean_text_kinds") > 0).select("job_index").distinct()
