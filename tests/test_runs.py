import json

import pytest
from pyspark.sql import functions as F

from comparing import DATA
from weftline.operators import lines, model_calls, ontology
from weftline.plans import pipeline, runs
from weftline.sources import readers, sinks
from weftline.streaming import incremental


def test_store_resumes_by_key(spark, tmp_path):
    store = runs.Store(spark, str(tmp_path))
    items = spark.range(10).withColumnRenamed("id", "job_index")
    asked = []

    def run(todo):
        asked.append(todo.count())
        return todo.withColumn("x", F.col("job_index") * 2)

    assert store.load_or_run("extract", "r1", "f", items.where("job_index < 6"), ["job_index"], run).count() == 6
    assert store.load_or_run("extract", "r1", "f", items, ["job_index"], run).count() == 10
    store.load_or_run("extract", "r1", "f", items, ["job_index"], run)
    store.load_or_run("extract", "r1", "g", items, ["job_index"], run)
    assert asked == [6, 4, 10]
    assert store.clone("extract", "r1", "r2") == 10
    with pytest.raises(ValueError):
        store.clone("verify", "r1", "r3")
    assert store.archive(str(tmp_path / "old"), keep=1) == ["r1"] and store.runs()[0] == "r2"
    assert store.archive(str(tmp_path / "old"), keep=1, dry_run=False) == ["r1"] and store.runs() == ["r2"]
    assert store.rerun_from("extract", "r2") == ["extract"] and store.runs() == []


def test_batches_are_committed_on_their_own(spark, tmp_path):
    store, asked = runs.Store(spark, str(tmp_path)), []
    items = spark.range(100).withColumnRenamed("id", "job_index")

    def run(todo):
        n = todo.count()
        if len(asked) == 2:
            raise RuntimeError("crash")
        asked.append(n)
        return todo

    with pytest.raises(RuntimeError):
        store.load_or_run("extract", "r", "f", items, ["job_index"], run, batch_items=25)
    kept = sum(asked)
    assert store.read("extract", "r", "f").count() == kept > 0
    asked.clear()
    assert store.load_or_run("extract", "r", "f", items, ["job_index"], lambda t: (asked.append(t.count()), t)[1], batch_items=1000).count() == 100
    assert asked == [100 - kept]


def test_fingerprints_follow_their_upstream():
    part = lambda model="m", prompt="p": {"model": model, "backend": "b", "prompts": [prompt], "settings": {}}
    base = {s: part() for s in runs.STAGES}
    a = runs.fingerprints(base, "1", "c")
    changed = lambda **kw: [s for s in runs.STAGES if a[s] != runs.fingerprints(base | kw, "1", "c")[s]]
    assert changed(requirement=part(prompt="new")) == ["requirement"]
    assert changed(hardsoft=part(model="new")) == ["hardsoft"]
    assert changed(verify=part(model="new")) == ["verify", "requirement", "hardsoft"]
    assert changed(extract=part(prompt="new")) == list(runs.STAGES)
    assert all(a[s] != runs.fingerprints(base, "1", "other")[s] for s in runs.STAGES)


def counting(name):
    """A stub that leaves a line in a file for every call."""

    class Counting:  # local, so that it is shipped by value
        model = name
        stub = model_calls.StubBackend(("Go", "Rust"))

        def call(self, role, prompt, values, endpoint=0):
            with open(f"{self.model}.{role}", "a") as f:
                f.write("x\n")
            return self.stub.call(role, prompt, values, endpoint)

    return Counting()


def small_jobs(spark):
    texts = [f"Requirements:\nExperience with Go and Rust, case {i}." for i in range(12)]
    return spark.createDataFrame([(i, str(i), "Dev", t) for i, t in enumerate(texts)], "job_index bigint, id string, title_raw string, description_raw string")


def test_a_changed_classifier_keeps_the_other_stages(spark, tmp_path):
    calls = lambda name: sum(1 for _ in open(f"{tmp_path}/{name}")) if (tmp_path / name).exists() else 0
    backend = lambda name: counting(f"{tmp_path}/{name}")
    cfg = lambda last: pipeline.Config(backend("e"), backend("v"), backend("r"), backend(last))
    first = pipeline.run_pipeline(spark, small_jobs(spark), cfg("h1"), str(tmp_path / "out"), "r", write_reports=False)
    before = [calls(x) for x in ("e.extract", "v.verify", "r.requirement", "h1.hardsoft")]
    assert before[0] == 12 and before[1] == 24 and min(before) > 0
    again = pipeline.run_pipeline(spark, small_jobs(spark), cfg("h2"), str(tmp_path / "out"), "r", write_reports=False)
    assert [calls(x) for x in ("e.extract", "v.verify", "r.requirement", "h1.hardsoft")] == before
    assert calls("h2.hardsoft") == before[3] and again["totals"] == first["totals"]
    summary = json.loads((tmp_path / "out" / "weftline_summary_run_r.json").read_text())
    assert summary["totals"] == again["totals"] and {c["model"] for c in summary["calls"]} >= {f"{tmp_path}/h2"}


def test_a_retry_is_kept_by_the_next_resume(spark, tmp_path):
    good, bad = model_calls.StubBackend(("Go", "Rust")), model_calls.StubBackend(("Go", "Rust"), fail_every=2)
    run = lambda b, **kw: pipeline.run_pipeline(spark, small_jobs(spark), pipeline.Config(b, good, good, good), str(tmp_path), "r", write_reports=False, **kw)["totals"]
    first = run(bad)
    assert first["jobs_failed"] > 0
    retried = run(good, retry_errors=True)
    assert retried["jobs_failed"] == 0 and retried["total_mentions"] == 24 > first["total_mentions"]
    assert run(good) == retried
    files = [p for p in (tmp_path / "stages" / "stage=extract" / "run_id=r").iterdir()]
    assert len(files) == 1  # one version, under its fingerprint


def test_pipeline_end_to_end(spark, tmp_path):
    jobs = lines.current_jobs(spark.read.parquet(f"{DATA}/jobs.parquet"))
    vocabulary = tuple(r.canonical_skill for r in spark.read.parquet(f"{DATA}/skill_reference.parquet").collect())
    stub = model_calls.StubBackend(vocabulary)
    cfg = pipeline.Config(stub, stub, stub, stub)
    out = pipeline.run_pipeline(spark, jobs, cfg, str(tmp_path), "r1")
    assert out["totals"]["total_jobs"] == jobs.count() and out["totals"]["total_mentions"] > 0
    m = spark.read.parquet(out["paths"]["mentions"])
    d = lines.describe(jobs).select("job_index", "description_normalized")
    wrong = m.join(d, "job_index").where(F.expr("substring(description_normalized, char_start + 1, length(skill_span)) != skill_span") & F.col("offset_valid"))
    assert wrong.count() == 0
    assert m.groupBy("mention_id").count().where("count > 1").count() == 0
    assert spark.read.json(out["paths"]["mentions_jsonl"]).count() == m.count()
    augmented = spark.read.json(out["paths"]["augmented"])
    meta = augmented.select("job_key", "extraction_metadata.*", F.size("skill_mentions").alias("n")).collect()
    assert len(meta) == jobs.count() and {r.run_id for r in meta} == {"r1"} and {r.models.extract for r in meta} == {"stub"} and "error" not in meta[0].__fields__  # nulls are left out
    assert sum(max(0, r.n) for r in meta if r.n is not None) == m.count()
    nested = spark.read.json(out["paths"]["title_skills_json"])
    flat = spark.read.parquet(out["paths"]["title_skills"])
    assert nested.select(F.sum(F.size("skills"))).first()[0] == flat.count() and nested.count() == flat.select("title").distinct().count()
    assert spark.read.json(out["paths"]["ontology_json"]).count() == spark.read.parquet(out["paths"]["ontology"]).count()
    pairs = [r.skill_a_jobs + r.skill_b_jobs for r in ontology.by_jobs(ontology.duplicate_pairs(spark.read.parquet(out["paths"]["ontology"]))).collect()]
    assert pairs == sorted(pairs, reverse=True)
    assert [s["stage"] for s in out["stages"]] == list(runs.STAGES) and all(s["errors"] == 0 and s["percent"] >= 100 for s in out["stages"][1:])
    again = pipeline.run_pipeline(spark, jobs, cfg, str(tmp_path), "r1", write_reports=False)
    assert again["totals"] == out["totals"]


def test_stream_equals_batch(spark, tmp_path):
    source = f"{tmp_path}/in"
    jobs = spark.read.parquet(f"{DATA}/jobs.parquet")
    jobs.repartition(3).write.parquet(source)
    incremental.start(spark, source, jobs.schema, f"{tmp_path}/out", f"{tmp_path}/cp", files_per_batch=1).awaitTermination()
    got = spark.read.parquet(f"{tmp_path}/out/lines").drop("batch")
    want = lines.label(lines.segment(lines.describe(jobs)))
    assert got.count() == want.count() and got.exceptAll(want.select(*got.columns)).count() == 0


def test_readers(spark, tmp_path):
    records = [{"id": 7, "JobTitle": " A ", "description": 5, "posting": "text"}, {"Title": "B", "job_description": "x"}, {"id": None}]
    for name, root in (("list", records), ("wrapped", {"jobs": records})):
        p = tmp_path / f"{name}.json"
        p.write_text(json.dumps(root))
        got = readers.read_jobs(spark, str(p)).orderBy("job_index").collect()
        assert [(r.job_index, r.id, r.title, r.description) for r in got] == [(0, "7", "A", "text"), (1, None, "B", "x"), (2, None, None, None)]
    (tmp_path / "one.json").write_text(json.dumps(records[0]))
    assert readers.read_jobs(spark, str(tmp_path / "one.json")).count() == 1
    (tmp_path / "j.jsonl").write_text("\n".join(map(json.dumps, records)) + "\n\n")
    assert [r.job_index for r in readers.read_job_lines(spark, str(tmp_path / "j.jsonl")).orderBy("job_index").collect()] == [0, 1, 2]
    (tmp_path / "c.jsonl").write_text('{"_meta": true, "run_id": "r"}\n{"job_index": 1}\n{"job_in\n\0\n{"_complete": true}\n')
    assert [r.job_index for r in readers.read_records(spark, str(tmp_path / "c.jsonl"), "job_index bigint").collect()] == [1]
    assert readers.is_complete(spark, str(tmp_path / "c.jsonl"))
    assert readers.run_id_of("/x/y_run_abc.json") == "abc" and readers.run_id_of("z.json") == "unknown"


def test_titles_and_calls(spark, tmp_path):
    (tmp_path / "t.csv").write_text("Raw_title,Normalized_title\nDev,Developer\n Dev ,Engineer\n,x\n")
    assert [tuple(r) for r in readers.read_titles(spark, str(tmp_path / "t.csv")).collect()] == [("Dev", "Engineer")]
    line = "2026-03-27 18:56:02,123 - DEBUG - llm - LLM m:1 [verifier] 1.5s | prompt=10 chars, resp=20 chars, eval=5 tok, 33.3 tok/s, total=1.6s"
    got = readers.parse_calls(spark.createDataFrame([(line,), ("noise",)], "value string")).collect()
    assert len(got) == 1 and (got[0].model, got[0].role, got[0].wall_time, got[0].eval_tokens, got[0].tok_s) == ("m:1", "verifier", 1.5, 5, 33.3)


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("a,b", 2), ("c", 1)], "status string, n bigint")
    sinks.write_counts(df, str(tmp_path / "q.csv"))
    assert (tmp_path / "q.csv").read_text().splitlines()[1] == '"a,b",2'
    sinks.write_counts(df, str(tmp_path / "l.csv"), legacy_format=True)
    assert (tmp_path / "l.csv").read_text() == "status,n\na,b,2\nc,1"
    sinks.write_json_array(df, str(tmp_path / "a.json"), pretty=True)
    assert json.loads((tmp_path / "a.json").read_text())[0] == {"status": "a,b", "n": 2}
    assert sinks.mentions_csv(df).columns == sinks.MENTION_CSV
    base = spark.createDataFrame([(1, "old")], "job_index bigint, x string")
    assert sinks.overlay(base, spark.createDataFrame([(1, "new")], base.schema)).first().x == "new"


def test_aliases_are_read(spark, tmp_path):
    (tmp_path / "a.csv").write_text("alias,target\n K8s ,Kubernetes\nk8s,kube\n,x\n")
    assert [tuple(r) for r in readers.read_aliases(spark, str(tmp_path / "a.csv")).collect()] == [("k8s", "kube")]


def test_settings_come_from_the_environment(tmp_path):
    from weftline.plans import cli

    (tmp_path / ".env").write_text("# comment\nexport WEFTLINE_KIND='ollama'\nWEFTLINE_ENDPOINTS=http://a,http://b\nOTHER=1\n")
    got = cli.environment({"WEFTLINE_KIND": "openai", "HOME": "/"}, str(tmp_path / ".env"))
    assert got == {"kind": "openai", "endpoints": "http://a,http://b"}
    a = cli.parser(got).parse_args(["run", "-i", "x", "-o", "y", "--classifier-model", "m"])
    assert (a.endpoint, a.kind, a.classifier_model) == (["http://a", "http://b"], "openai", "m")
    assert cli.eta(10, 30, 60.0) == "2m00s" and cli.eta(0, 5, 1.0) == "unknown"


def test_core_does_not_need_the_subpackage():
    import subprocess
    import sys
    from pathlib import Path

    from weftline.plans import queries as core

    names = sorted(core.queries())
    code = (
        "import sys, importlib.abc\n"
        "class Gone(importlib.abc.MetaPathFinder):\n"
        "    def find_spec(self, name, path=None, target=None):\n"
        "        if name.startswith('weftline.llm'): raise ModuleNotFoundError(name, name='weftline.llm')\n"
        "sys.meta_path.insert(0, Gone())\n"
        f"import __spark_entry__ as e\nassert sorted(e.queries()) == {names!r}\nassert set(e.oracle_sql()) <= set(e.queries())\n"
        "import weftline.plans.cli, weftline.streaming.incremental\nassert not [m for m in sys.modules if m.startswith('weftline.llm')]"
    )
    assert subprocess.run([sys.executable, "-c", code], cwd=Path(__file__).resolve().parent.parent).returncode == 0
