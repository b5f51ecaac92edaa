import json

import pytest
from pyspark.sql import functions as F

from weftline.functions import scoring as S
from weftline.operators import assemble, model_calls, ontology, reports, titles

CONFIDENCE = [
    (0.8, "accepted", 0.9, "completed", 0.8, "completed", 0.9, "requirements", "skills_relevant", True, True, 0.9135),
    (0.8, "rejected", 0.9, "skipped", None, "skipped", None, "body", "skills_relevant", True, True, 0.855),
    (0.8, "parse_failed", None, "skipped", None, "skipped", None, "body", "uncertain", True, True, 0.58),
    (0.8, "extractor", 0.8, "extractor", 0.8, "extractor", 0.8, "body", "skills_relevant", True, True, 0.8),
    (0.2, "error", None, "error", None, "error", None, "legal", "likely_legal", False, False, 0.0),
    (1.0, "accepted", 1.0, "completed", 1.0, "completed", 1.0, "requirements", "skills_relevant", True, True, 1.0),
]


def test_confidence(spark):
    df = spark.createDataFrame(CONFIDENCE, "raw double, vs string, vc double, rs string, rc double, hs string, hc double, section string, label string, ok boolean, ev boolean, want double")
    c = F.col
    got = df.select(S.final_confidence(c("raw"), c("vs"), c("vc"), c("rs"), c("rc"), c("hs"), c("hc"), c("section"), c("label"), F.lit(0), c("ok"), c("ev")).alias("got"), "want")
    for r in got.collect():
        assert r.got == pytest.approx(r.want, abs=1e-4)


def test_canonical_keys(spark):
    want = {" Python  Skills ": "python", "JS": "javascript", "K8s": "kubernetes", "gcp": "google cloud platform", "Google Cloud Platform": "google cloud", ".NET": "net", ".NET Framework": "net", "ms teams": "teams", "js framework": "javascript", "rust language": "rust language", "python skills.": "python skills", "skills": "skills", "Ｐython": "python"}
    df = spark.createDataFrame([(k,) for k in want], "x string")
    assert {r.x: r.canonical_key for r in S.with_canonical(df, "x").collect()} == want
    table = spark.createDataFrame([("js", "javascript"), ("js", "javascript")], "alias string, target string")
    assert {r.x: r.canonical_key for r in S.with_canonical(df, "x", aliases=table).collect()}["js framework"] == "javascript"


def mention_rows(spark, rows):
    return spark.createDataFrame(rows, "job_index bigint, mention_idx int, is_skill boolean, requirement_level string, hard_soft string, raw_model_confidence double")


@pytest.mark.parametrize("status,extractor,want", [("accepted", False, (True, "accepted")), ("rejected", True, (False, "rejected")), ("parse_failed", True, (False, "parse_failed")), ("error", True, (False, "error")), (None, True, (True, "extractor")), (None, False, (False, "extractor")), (None, None, (True, "skipped"))])
def test_who_decides(spark, status, extractor, want):
    m = mention_rows(spark, [(1, 0, extractor, "required", "other", 0.7)])
    v = spark.createDataFrame([(1, 0, status, 0.9, status == "accepted")] if status else [], "job_index bigint, mention_idx int, status string, confidence double, is_skill boolean")
    r = spark.createDataFrame([], "job_index bigint, mention_idx int, status string, confidence double, requirement_level string")
    h = spark.createDataFrame([(1, 0, "completed", 0.5, "odd value"), (1, 0, "completed", 0.5, "odd value")], "job_index bigint, mention_idx int, status string, confidence double, hard_soft string")
    got = assemble.merge_stages(m, v, r, h).collect()
    assert len(got) == 1
    assert (got[0].is_skill, got[0].verifier_status) == want
    assert (got[0].requirement_level, got[0].requirement_status) == ("required", "extractor")
    assert (got[0].hard_soft, got[0].hardsoft_status) == ("odd value", "completed")


def test_duplicate_pairs(spark):
    counts = {"microsoft excel": 5, "excel": 9, "go tools": 2, "go": 1, "java 8": 3, "java": 30, "sql": 25, "sql tuning": 4, "nosql": 40, "c++": 50, "modern c++": 3}
    df = spark.createDataFrame([(k, k.title(), v) for k, v in counts.items()], "canonical_key string, canonical_skill string, job_count bigint")
    got = {tuple(sorted((r.key_a, r.key_b))): (r.reason, r.suggested_target) for r in ontology.duplicate_pairs(df).collect()}
    assert got == {("excel", "microsoft excel"): ("microsoft_prefix", "Excel"), ("go", "go tools"): ("qualifier_suffix", "Go"), ("java", "java 8"): ("version_variant", "Java"), ("sql", "sql tuning"): ("substring_containment", "Sql")}
    few = spark.createDataFrame([("sql", "SQL", 5), ("sql tuning", "x", 4)], df.schema)
    assert ontology.duplicate_pairs(few).count() == 0


def test_containment_is_that_of_the_pattern(spark):
    import itertools
    import random
    import re

    rng = random.Random(3)
    keys = {" ".join(rng.choice(["ab", "abc", "c++", "d-e", "x1", "ü"]) for _ in range(rng.randint(1, 3))) for _ in range(60)}
    df = spark.createDataFrame([(k, k, 20) for k in keys], "canonical_key string, canonical_skill string, job_count bigint")
    want = {(a, b) for a, b in itertools.permutations(keys, 2) if 3 <= len(a) < len(b) and re.search(r"\b" + re.escape(a) + r"\b", b)}
    got = {(r.key_a, r.key_b) for r in ontology.duplicate_pairs(df).collect() if r.reason == "substring_containment"}
    assert got == want


MENTION = "job_index bigint, mention_idx int, job_id string, title_raw string, skill_span string, normalized_candidate string, is_skill boolean, hard_soft string, requirement_level string, final_confidence double"


def test_ontology_ties_and_nulls(spark):
    rows = [(1, 0, None, "Dev", "SQL", None, True, "soft", None, 0.5), (1, 1, None, " ", "SQL", "sql", True, "hard", "required", None), (2, 0, None, None, "x", "  ", True, None, "required", 0.9), (3, 0, "a", "Dev", "Go", "Go", False, "hard", "required", 0.9)]
    df = spark.createDataFrame(rows, MENTION)
    got = {r.canonical_key: r for r in ontology.build_ontology(df).collect()}
    assert set(got) == {"sql"}
    assert (got["sql"].type, got["sql"].job_count, got["sql"].mention_count, got["sql"].avg_confidence, got["sql"].canonical_skill) == ("soft", 1, 2, 0.5, "SQL") or got["sql"].canonical_skill == "sql"
    assert ontology.build_ontology(df.limit(0)).count() == 0


def test_title_skills(spark):
    rows = [(1, 0, "a", "Dev", "Go", "Go", True, "hard", "required", 0.9), (1, 1, "a", "Dev", "Go", "go", True, "hard", "required", 0.9), (2, 0, "b", "dev ", "Go", "Go", True, "soft", "required", None), (3, 0, "c", "Dev", "Tea", "Tea", True, "soft", "required", 0.1)]
    m = spark.createDataFrame(rows, MENTION)
    got = titles.title_skills(m.select("job_index", "job_id", "title_raw").distinct(), m).collect()
    assert [(r.title, r.job_count, r.canonical_key, r.points, r.type, r.posting_count) for r in got] == [("dev", 3, "go", 2.0, "hard", 2)]


def test_summary_matches_statistics(spark):
    import random
    import statistics

    rng = random.Random(1)
    n = sorted(rng.randint(0, 9) for _ in range(37))
    got = reports.extraction_summary(spark.createDataFrame(list(enumerate(n)), "job_index bigint, n bigint")).first()
    assert (got.median, got.q1, got.q3, got.zero_jobs) == (statistics.median(n), n[len(n) // 4], n[3 * len(n) // 4], n.count(0))
    assert got.stdev == pytest.approx(statistics.stdev(n), abs=1e-3)


def test_keep_apart(spark):
    df = spark.createDataFrame([("m", p, p) for p in (1, 50, 102, 180, 203, 400)], "model string, position bigint, v bigint")
    assert sorted(r.position for r in reports.keep_apart(df, ["model"]).collect()) == [1, 102, 203, 400]


def test_replies():
    assert model_calls.loose_json('<think>no</think> ```json\n{"a": [1, 2,],}\n```') == {"a": [1, 2]}
    with pytest.raises(ValueError):
        model_calls.loose_json('{"mentions": [')


class Failing:
    """Unreadable replies for texts over 3,000 characters."""

    model = "failing"

    def call(self, role, prompt, values, endpoint=0):
        return "{" if len(values["text"]) > 3000 else json.dumps({"mentions": [{"skill_span": values["text"][:4]}]})


def test_recovery():
    once = lambda t, n=1, chunks=(): model_calls.extract_job(Failing(), t, n, list(chunks), 0)
    assert once("short text") == ([{"skill_span": "shor"}], None)
    text = "A sentence here. " * 800
    found, error = once(text, 1, [text[:7000], " ", text[7000:]])
    assert error is None and len(found) > 2
    assert once("x" * 3500)[1].startswith("unreadable_reply")
    assert once("x" * 3500, 30, ["ok", "x" * 3500])[0][0] == {"skill_span": "ok"}
    assert once("x" * 7000, 1, []) == ([], None)


def test_extraction_reads_the_raw_text_first_then_chunks_by_section(spark):
    class Recording:  # local, so that it is shipped by value
        model = "recording"

        def call(self, role, prompt, values, endpoint=0):
            import json

            return json.dumps({"mentions": [{"skill_span": values["text"][:6]}]}) if len(values["text"]) < 3000 else "{"

    long = "Requirements:\n" + "x" * 2600 + "\nEducation:\n" + "y" * 2600 + "\n" + "z" * 2000
    d = spark.createDataFrame([(1, "raw text", "normal"), (2, long, long), (3, "", "")], "job_index bigint, description_raw string, description_normalized string")
    got = {}
    for r in model_calls.extract(d, Recording(), window=2).orderBy("job_index", "mention_idx").collect():
        got.setdefault(r.job_index, []).append((r.mention_idx, r.skill_span, r.error))
    assert got[1] == [(0, "raw te", None)] and got[3] == [(-1, None, None)]
    assert [x[1] for x in got[2]] == ["Requir", "Educat", "yyyyyy"]  # the second chunk is halved once


def test_calls_keep_their_order_and_their_window():
    import threading
    import time

    at_once, most, lock = 0, 0, threading.Lock()

    def work(n, x):
        nonlocal at_once, most
        with lock:
            at_once += 1
            most = max(most, at_once)
        time.sleep(0.002 * (x % 3))
        with lock:
            at_once -= 1
        return n, x

    assert list(model_calls.in_order(work, range(40), 3)) == [(i, i) for i in range(40)]
    assert 1 < most <= 3


def test_connections_stay_open_and_fail_over():
    import http.server
    import threading

    ports, bodies = set(), []

    class Handler(http.server.BaseHTTPRequestHandler):
        protocol_version = "HTTP/1.1"

        def do_POST(self):
            ports.add(self.client_address[1])
            bodies.append(json.loads(self.rfile.read(int(self.headers["Content-Length"]))))
            data = json.dumps({"choices": [{"message": {"content": "ok"}}]}).encode()
            self.send_response(200)
            self.send_header("Content-Length", str(len(data)))
            self.end_headers()
            self.wfile.write(data)

        def log_message(self, *args):
            pass

    server = http.server.ThreadingHTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    try:
        b = model_calls.HttpBackend(("http://127.0.0.1:9/v1", f"http://127.0.0.1:{server.server_port}/v1"), "Qwen-x", retries=1, timeout=5)
        assert [b.call("verify", "q", {}, e) for e in (1, 1, 0)] == ["ok"] * 3
        assert len(ports) == 1
        assert bodies[0]["messages"][0]["role"] == "system" and bodies[0]["messages"][1]["content"] == "q\n/no_think"
        assert bodies[0]["logit_bias"] == {"151667": -100} and bodies[0]["temperature"] == 0.05
        plain = model_calls.HttpBackend(b.endpoints, "other").payload("extract", "q")[1]
        assert "logit_bias" not in plain and plain["messages"][1]["content"] == "q"
        with pytest.raises(model_calls.CallFailed):
            model_calls.HttpBackend(("http://127.0.0.1:9",), "m", retries=1, backoff=0.0).call("verify", "q", {})
    finally:
        server.shutdown()
        server.server_close()


def test_stub_classification(spark):
    m = spark.createDataFrame([(1, 0, "Teamwork", "requirements", "Teamwork and Go"), (1, 1, "Go", None, None)], "job_index bigint, mention_idx int, skill_span string, section string, source_line string")
    assert {r.skill_span if "skill_span" in r else r.hard_soft for r in model_calls.classify(m, model_calls.StubBackend(), "hardsoft").collect()} == {"soft", "hard"}
    assert {r.requirement_level for r in model_calls.classify(m, model_calls.StubBackend(), "requirement").collect()} == {"required", "unclear"}
    broken = model_calls.StubBackend(fail_every=1)
    assert {r.status for r in model_calls.classify(m, broken, "verify").collect()} <= {"parse_failed", "accepted", "rejected"}
