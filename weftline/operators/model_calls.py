"""Language models as operators: a call per row in Arrow batches, replies parsed tolerantly, failures kept as rows.

Backends are small objects that are shipped to the tasks: a deterministic one for tests, and HTTP clients of chat endpoints.
A partition has a bounded window of calls under way at once, and rows leave in the order they came. A call prefers one endpoint and goes
on to the others when that fails; connections stay open, one to an endpoint for each thread. Calls are dear and not repeatable, so their
results should be written to a stage table before anything reads them twice.
"""

from __future__ import annotations

import functools
import hashlib
import http.client
import json
import re
import threading
import time
from collections import deque
from collections.abc import Callable, Iterable, Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from urllib.parse import urlsplit

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.operators.lines import batches, split_near_middle, with_chunks

# When and how far a failed extraction is cut smaller.
RETRY_MIN_CHARS, RETRY_MIN_LINES, SPLIT_MIN_CHARS, SPLIT_DEPTH = 6000, 24, 2500, 3
# Model families that reason unless told not to: what ends the prompt, and the token that must not be produced.
QUIET = {"qwen": ("/no_think", 151667)}
MAX_TOKENS = 4096
WINDOW = 4  # calls under way at once in a partition

SYSTEMS = {
    "extract": "You read job postings and name the competencies they ask for. You answer in JSON only.",
    "verify": "You decide whether a phrase names a competency in its line. You answer in JSON only.",
    "requirement": "You decide how strongly a line asks for a competency. You answer in JSON only.",
    "hardsoft": "You tell hard skills from soft skills. You answer in JSON only.",
}
PROMPTS = {
    "extract": 'List every competency the posting asks for as JSON {{"mentions": [{{"skill_span", "context", "section", "normalized_skill", "evidence", "confidence", "requirement", "hard_soft"}}]}}. Spans must be copied from the text.\n\n{text}',
    "verify": 'Is "{span}" a competency in this line? Answer as JSON {{"is_skill", "confidence", "evidence", "notes"}}.\n\nSection: {section}\nLine: {line}',
    "requirement": 'Is "{span}" required, optional or unclear here? Answer as JSON {{"requirement_level", "confidence", "evidence", "notes"}}.\n\nSection: {section}\nLine: {line}',
    "hardsoft": 'Is "{span}" a hard or soft skill, or unknown? Answer as JSON {{"hard_soft", "confidence", "evidence", "notes"}}.\n\nSection: {section}\nLine: {line}',
}


@functools.lru_cache(16)
def any_of(terms: tuple[str, ...]) -> re.Pattern:
    return re.compile(rf"(?i)(?<!\w)(?:{'|'.join(re.escape(t) for t in sorted(terms, key=lambda t: (-len(t), t)))})(?!\w)")


@dataclass
class StubBackend:
    """Deterministic replies from a vocabulary, as a model might give them; no network."""

    vocabulary: tuple[str, ...] = ()
    model: str = "stub"
    fail_every: int = 0  # every n-th text, by hash, gets an unreadable reply

    def call(self, role: str, prompt: str, values: dict, endpoint: int = 0) -> str:
        h = int(hashlib.md5(f"{role}|{values.get('span', '')}|{values.get('line', '')}|{values.get('text', '')}".encode()).hexdigest()[:8], 16)
        if self.fail_every and h % self.fail_every == 0:
            return '{"mentions": ['
        confidence = round(0.5 + h % 50 / 100, 2)
        if role == "extract":
            text, found = values["text"], []
            names = {t.lower(): t for t in self.vocabulary}
            for m in any_of(self.vocabulary).finditer(text) if self.vocabulary else ():
                line = text[text.rfind("\n", 0, m.start()) + 1 :].split("\n", 1)[0]
                found.append({"skill_span": m[0], "context": line, "section": "General", "normalized_skill": names.get(m[0].lower(), m[0]), "evidence": line, "confidence": confidence, "requirement": "unclear", "hard_soft": "hard"})
            return "```json\n" + json.dumps({"mentions": found}, ensure_ascii=False) + "\n```"
        if role == "verify":
            return json.dumps({"is_skill": h % 10 != 0, "confidence": confidence, "evidence": values["span"], "notes": ""})
        if role == "requirement":
            level = "required" if values.get("section") == "requirements" else "optional" if values.get("section") == "preferred" else "unclear"
            return json.dumps({"requirement_level": level, "confidence": confidence, "evidence": values["span"], "notes": ""})
        return json.dumps({"hard_soft": "soft" if re.search(r"(?i)team|communicat|mentor|listen|negotiat|writing|adapt", values["span"]) else "hard", "confidence": confidence, "evidence": values["span"], "notes": ""})


@dataclass
class HttpBackend:
    """A chat endpoint; ``kind`` is 'openai' (``/chat/completions``) or 'ollama' (``/api/chat``)."""

    endpoints: tuple[str, ...]
    model: str
    kind: str = "openai"
    temperature: dict = field(default_factory=lambda: {"extract": 0.1})
    thinking: bool = False
    timeout: float = 300.0
    retries: int = 3
    backoff: float = 1.5
    key: str | None = None

    def payload(self, role: str, prompt: str) -> tuple[str, dict]:
        shape = next((v for k, v in QUIET.items() if k in self.model.lower()), None) if not self.thinking else None
        if shape and not prompt.rstrip().endswith(shape[0]):
            prompt = f"{prompt.rstrip()}\n{shape[0]}"
        body = {"model": self.model, "messages": [{"role": "system", "content": SYSTEMS[role]}, {"role": "user", "content": prompt}], "stream": False}
        t = self.temperature.get(role, 0.05)
        if self.kind == "ollama":
            return "/api/chat", body | {"think": self.thinking, "options": {"temperature": t}}
        quiet = {"chat_template_kwargs": {"enable_thinking": False}, "logit_bias": {str(shape[1]): -100}} if shape else {}
        return "/chat/completions", body | {"temperature": t, "max_tokens": MAX_TOKENS} | quiet

    def call(self, role: str, prompt: str, values: dict, endpoint: int = 0) -> str:
        path, body = self.payload(role, prompt)
        head = {"Content-Type": "application/json"} | ({"Authorization": f"Bearer {self.key}"} if self.key else {})
        error: Exception | None = None
        for n in range(self.retries):
            for k in range(len(self.endpoints)):  # the preferred endpoint first, then the others
                url = self.endpoints[(endpoint + k) % len(self.endpoints)].rstrip("/") + path
                try:
                    data = json.loads(post(url, json.dumps(body).encode(), head, self.timeout))
                    message = data["message"] if self.kind == "ollama" else data["choices"][0]["message"]
                    return message["content"]
                except (OSError, http.client.HTTPException, LookupError, TypeError, ValueError) as e:
                    error = e
            time.sleep(self.backoff * (n + 1))
        raise CallFailed(f"call_failed: {error}")


class CallFailed(RuntimeError):
    """No endpoint gave a reply."""


_OPEN = threading.local()


def post(url: str, body: bytes, head: dict, timeout: float) -> bytes:
    """A POST over this thread's connection to the endpoint; one that the server closed meanwhile is opened once again."""
    u = urlsplit(url)
    held = _OPEN.__dict__.setdefault("connections", {})
    for kept in (True, False):
        c = held.pop((u.scheme, u.netloc), None) if kept else None
        if kept and c is None:
            continue
        c = c or (http.client.HTTPSConnection if u.scheme == "https" else http.client.HTTPConnection)(u.netloc, timeout=timeout)
        try:
            c.request("POST", u.path + (f"?{u.query}" if u.query else ""), body, head)
            reply = c.getresponse()
            data = reply.read()
        except (OSError, http.client.HTTPException):
            c.close()
            if kept:
                continue
            raise
        if reply.will_close:
            c.close()
        else:
            held[u.scheme, u.netloc] = c
        if reply.status >= 400:
            raise OSError(f"status {reply.status}")
        return data
    raise OSError("no connection")


def without_thinking(reply: str) -> str:
    return re.sub(r"(?is)^(\s*<think\b[^>]*>.*?</think>\s*)+", "", reply or "")


def loose_json(reply: str):
    """The JSON of a reply: thinking and code fence removed, cut to the outermost brackets, trailing commas forgiven."""
    t = without_thinking(reply).strip()
    if m := re.search(r"(?is)```(?:json)?\s*(.*?)\s*```", t):
        t = m[1].strip()
    if m := re.search(r"(?s)[\[{].*[\]}]", t):
        t = m[0]
    try:
        return json.loads(t)
    except ValueError:
        return json.loads(re.sub(r",\s*([\]}])", r"\1", t))


def extract_once(backend, text: str, endpoint: int) -> list[dict]:
    """The mentions of one call; an empty list is a success, anything but a list a failure."""
    try:
        data = loose_json(backend.call("extract", PROMPTS["extract"].format(text=text), {"text": text}, endpoint))
    except ValueError as e:
        raise ValueError(f"unreadable_reply: {e}") from e
    mentions = data.get("mentions") if isinstance(data, dict) else data
    if not isinstance(mentions, list):
        raise ValueError("invalid_reply: no list of mentions")
    return [m for m in mentions if isinstance(m, dict)]


def extract_job(backend, text: str, n_lines: int, chunks: list[str], endpoint: int) -> tuple[list[dict], str | None]:
    """A job's mentions from its raw text; where the reply to a long one is unreadable, from its chunks.

    Chunks with unreadable replies are halved, and their halves. Part of the mentions is a success; else the first error counts.
    """
    found: list[dict] = []
    try:
        return extract_once(backend, text, endpoint), None
    except CallFailed as e:
        return [], str(e)
    except ValueError as e:
        errors = [str(e)]
        if len(text) < RETRY_MIN_CHARS and n_lines < RETRY_MIN_LINES:
            return [], errors[0]
    errors.clear()
    todo = deque((c, 0) for c in chunks if c.strip())
    while todo:
        part, depth = todo.popleft()
        try:
            found += extract_once(backend, part, endpoint)
        except CallFailed as e:
            errors.append(str(e))
        except ValueError as e:
            halves = split_near_middle(part) if depth < SPLIT_DEPTH and len(part) >= SPLIT_MIN_CHARS else None
            if halves:
                todo.extendleft((h, depth + 1) for h in reversed(halves))
            else:
                errors.append(str(e))
    return found, errors[0] if errors and not found else None


MENTION = "mention_idx int, skill_span string, context string, section_hint string, normalized_candidate string, evidence string, raw_model_confidence double, requirement_level string, hard_soft string, extractor_model string, error string, seconds double"


def number(x, default: float | None) -> float | None:
    try:
        return float(x)
    except (TypeError, ValueError):
        return default


def in_order(work: Callable, items: Iterable, window: int) -> Iterator:
    """``work(number, item)`` of each item, in order; at most ``window`` are under way and twice as many held."""
    with ThreadPoolExecutor(max_workers=max(1, window)) as pool:
        waiting: deque = deque()
        for n, item in enumerate(items):
            waiting.append(pool.submit(work, n, item))
            if len(waiting) >= 2 * window:
                yield waiting.popleft().result()
        while waiting:
            yield waiting.popleft().result()


def first_endpoint() -> int:
    from pyspark import TaskContext

    context = TaskContext.get()
    return context.partitionId() if context else 0


def mention_rows(found: list[dict], model: str, error: str | None, took: float) -> list[tuple]:
    """MENTION values of a job's replies; one of mention_idx -1 if there are none."""
    rows = []
    for m in found:
        span = m.get("skill_span") or ""
        if not isinstance(span, str) or not span.strip():
            continue
        word = lambda key, words, default: w if (w := str(m.get(key, default)).lower()) in words else default
        confidence = number(m.get("confidence", m.get("span_confidence", 0.7)), 0.7)
        rows.append((len(rows), span, m.get("context") or "", m.get("section") or "General", m.get("normalized_skill", span), str(m.get("evidence", span) or ""), confidence, word("requirement", ("required", "optional", "unclear"), "unclear"), word("hard_soft", ("hard", "soft", "unknown"), "unknown"), model, None, took))
    return rows or [(-1, *[None] * 8, model, error, took)]


def extract_rows(asked: DataFrame, keys: list[str], backend, fallback=None, endpoints: int = 1, window: int = WINDOW) -> DataFrame:
    """``keys`` and MENTION for each row of ``keys, text, n_lines, chunks``."""
    schema = ", ".join([f"{k} {asked.schema[k].dataType.simpleString()}" for k in keys]) + ", " + MENTION
    names = [*keys, *[c.split()[0] for c in MENTION.split(", ")]]

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        first = first_endpoint()

        def work(n: int, row) -> list[tuple]:
            began, model, endpoint = time.time(), backend.model, (first + n) % max(1, endpoints)
            found, error = extract_job(backend, row.text, row.n_lines, list(row.chunks), endpoint) if row.text else ([], None)
            if error and fallback is not None:
                model = fallback.model
                found, error = extract_job(fallback, row.text, row.n_lines, list(row.chunks), endpoint)
            head = tuple(getattr(row, k) for k in keys)
            return [(*head, *r) for r in mention_rows(found, model, error, time.time() - began)]

        for b in parts:
            rows = [r for rs in in_order(work, b.itertuples(), window) for r in rs]
            yield pd.DataFrame(rows, columns=names).astype({"raw_model_confidence": "float64"})

    return asked.select(*keys, "text", "n_lines", "chunks").mapInPandas(run, schema)


def extract(described: DataFrame, backend, fallback=None, endpoints: int = 1, window: int = WINDOW) -> DataFrame:
    """job_index and MENTION rows per job; a failed job, or one without mentions, has one row with mention_idx -1 and its error (null if none).

    The first call has the raw text, or the normalized one where the table has no other; a retry's chunks follow the sections.
    """
    first = F.col("description_raw" if "description_raw" in described.columns else "description_normalized")
    rows = described.select("job_index", first.alias("text"), F.coalesce("description_normalized", F.lit("")).alias("description_normalized"))
    full = with_chunks(rows, "job_index", "text")
    empty = rows.where("description_normalized = ''").select("job_index", F.lit("").alias("text"), F.lit(0).alias("n_lines"), F.array().cast("array<string>").alias("chunks"))
    return extract_rows(full.unionByName(empty), ["job_index"], backend, fallback, endpoints, window)


def extract_batches(lines: DataFrame, backend, size: int = 5, endpoints: int = 1, window: int = WINDOW) -> DataFrame:
    """The older way: a call per ``size`` lines; mention_idx counts within a batch, whose number is ``batch``."""
    asked = batches(lines, size).select("job_index", "batch", "text", F.lit(size).alias("n_lines"), F.array("text").alias("chunks"))
    return extract_rows(asked, ["job_index", "batch"], backend, endpoints=endpoints, window=window)


VERDICT = "job_index bigint, mention_idx int, status string, {value} {kind}, confidence double, evidence string, notes string, model string, seconds double"


def classify(mentions: DataFrame, backend, role: str, endpoints: int = 1, window: int = WINDOW) -> DataFrame:
    """A verdict per row of ``job_index, mention_idx, skill_span, section, source_line``; role is verify, requirement or hardsoft.

    Unreadable replies are 'parse_failed', failed calls 'error'; a verifier's others 'accepted' or 'rejected', a classifier's 'completed'.
    """
    value, kind = {"verify": ("is_skill", "boolean"), "requirement": ("requirement_level", "string"), "hardsoft": ("hard_soft", "string")}[role]
    schema = VERDICT.format(value=value, kind=kind)

    def one(row, endpoint: int) -> tuple:
        values = {"span": row.skill_span, "section": row.section or "", "line": row.source_line or ""}
        try:
            data = loose_json(backend.call(role, PROMPTS[role].format(**values), values, endpoint))
            if not isinstance(data, dict):
                raise ValueError("no object")
        except ValueError as e:
            return "parse_failed", None, None, "", str(e)
        except CallFailed as e:
            return "error", None, None, "", str(e)
        evidence, notes = str(data.get("evidence", "")), str(data.get("notes", ""))
        if role == "verify":
            ok = bool(data.get("is_skill"))
            return "accepted" if ok else "rejected", ok, number(data.get("confidence"), None), evidence, notes
        confidence = data.get("confidence")
        if confidence is not None and number(confidence, None) is None:
            return "error", None, None, evidence, "confidence is no number"
        default = "unclear" if role == "requirement" else "unknown"
        return "completed", str(data.get(value) or default).lower(), number(confidence, None), evidence, notes

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        first = first_endpoint()

        def work(n: int, row) -> tuple:
            began = time.time()
            return (row.job_index, row.mention_idx, *one(row, (first + n) % max(1, endpoints)), backend.model, time.time() - began)

        for b in parts:
            out = pd.DataFrame(list(in_order(work, b.itertuples(), window)), columns=[c.split()[0] for c in schema.split(", ")])
            yield out.astype({"confidence": "float64"})

    return mentions.select("job_index", "mention_idx", "skill_span", "section", "source_line").mapInPandas(run, schema)


def call_timing(*stages: DataFrame) -> DataFrame:
    """``model, calls, seconds`` from the seconds that each result row carries."""
    parts = [df.select(F.col("model" if "model" in df.columns else "extractor_model").alias("model"), "seconds") for df in stages]
    return functools.reduce(DataFrame.unionByName, parts).groupBy("model").agg(F.count("*").alias("calls"), F.sum("seconds").alias("seconds"))
