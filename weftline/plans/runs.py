"""Stage tables with a manifest: what is finished is reused, what is missing is added, what changed is made anew.

A stage is a Parquet folder ``stage=…/run_id=…/fingerprint=…`` of parts; its manifest rows are JSON files beside it. A resumed
stage computes only the items without a row under the same fingerprint, by key, so a lost or corrupt part costs its own rows only.
Items are computed in batches, each committed on its own, so a crash loses one batch of calls. Rows that take the place of older ones are written
as a new version of the folder, which is then exchanged for the old one by renaming.
"""

from __future__ import annotations

import json
import shutil
import time
from collections.abc import Callable
from dataclasses import asdict, dataclass
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.functions.scoring import fingerprint
from weftline.operators.assemble import upsert
from weftline.session import cut

# Stages in order, and what each is made from.
STAGES = ("extract", "verify", "requirement", "hardsoft")
UPSTREAM = {"extract": None, "verify": "extract", "requirement": "verify", "hardsoft": "verify"}
BATCH_ITEMS = 50_000  # items of a stage that are committed together


@dataclass
class Manifest:
    stage: str
    run_id: str
    fingerprint: str
    expected: int
    records: int
    complete: bool
    started: float
    ended: float
    errors: int = 0


def failed_rows(df: DataFrame) -> int:
    """Rows of a stage that hold an error in place of a result."""
    if "error" in df.columns:
        return df.where(F.col("error").isNotNull()).count()
    return df.where(F.col("status").isin("error", "parse_failed")).count() if "status" in df.columns else 0


class Store:
    """Stage tables below a folder that all executors share."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, Path(root)

    def path(self, stage: str, run_id: str, print_: str) -> Path:
        return self.root / f"stage={stage}" / f"run_id={run_id}" / f"fingerprint={print_}"

    def manifest_path(self, stage: str, run_id: str) -> Path:
        return self.root / "manifest" / f"{run_id}.{stage}.json"

    def manifest(self, stage: str, run_id: str) -> Manifest | None:
        p = self.manifest_path(stage, run_id)
        try:
            return Manifest(**json.loads(p.read_text()))
        except (OSError, ValueError, TypeError):
            return None

    def put(self, m: Manifest) -> None:
        p = self.manifest_path(m.stage, m.run_id)
        p.parent.mkdir(parents=True, exist_ok=True)
        p.with_suffix(".tmp").write_text(json.dumps(asdict(m)))
        p.with_suffix(".tmp").rename(p)

    def read(self, stage: str, run_id: str, print_: str) -> DataFrame | None:
        p = self.path(stage, run_id, print_)
        kept = p.with_name(f"{p.name}.old")
        if not p.exists() and kept.exists():  # a crash between the two renamings of ``replace``
            kept.rename(p)
        return self.spark.read.parquet(str(p)) if p.exists() and any(p.rglob("*.parquet")) else None

    def load_or_run(self, stage: str, run_id: str, print_: str, items: DataFrame, keys: list[str], run: Callable[[DataFrame], DataFrame], batch_items: int = BATCH_ITEMS) -> DataFrame:
        """The stage's rows: as they are if finished, else with the missing items computed and appended."""
        m, old = self.manifest(stage, run_id), self.read(stage, run_id, print_)
        expected = items.count()
        if m and m.complete and m.fingerprint == print_ and m.expected == expected and old is not None:
            return old
        began = time.time()
        todo = items if old is None else items.join(old.select(*keys).distinct(), keys, "left_anti")
        parts = -(-(expected if old is None else todo.count()) // batch_items)
        if parts > 1:
            todo = cut(todo)
        share = F.pmod(F.xxhash64(*keys, F.lit("batch")), F.lit(max(1, parts)))
        for k in range(max(1, parts)):
            batch = todo.where(share == k) if parts > 1 else todo
            run(batch).sortWithinPartitions(*keys).write.mode("append").parquet(str(self.path(stage, run_id, print_)))
        return self.finished(stage, run_id, print_, expected, began)

    def finished(self, stage: str, run_id: str, print_: str, expected: int, began: float) -> DataFrame:
        done = self.spark.read.parquet(str(self.path(stage, run_id, print_)))
        self.put(Manifest(stage, run_id, print_, expected, done.count(), True, began, time.time(), failed_rows(done)))
        return done

    def replace(self, stage: str, run_id: str, print_: str, rows: DataFrame, keys: list[str]) -> DataFrame:
        """The stage with ``rows`` in place of those of the same keys; a later resume finds the new ones."""
        began, p = time.time(), self.path(stage, run_id, print_)
        m = self.manifest(stage, run_id)
        fresh, kept = p.with_name(f"{p.name}.new"), p.with_name(f"{p.name}.old")
        new = cut(rows)  # read twice below, and perhaps made by calls
        upsert(self.read(stage, run_id, print_), new, keys).sortWithinPartitions(*keys).write.mode("overwrite").parquet(str(fresh))
        p.rename(kept)
        fresh.rename(p)
        shutil.rmtree(kept)
        return self.finished(stage, run_id, print_, m.expected if m else 0, began)

    def rerun_from(self, stage: str, run_id: str) -> list[str]:
        """Forget a stage and all later ones."""
        dropped = []
        for s in STAGES[STAGES.index(stage) :]:
            self.manifest_path(s, run_id).unlink(missing_ok=True)
            folder = self.root / f"stage={s}" / f"run_id={run_id}"
            if folder.exists():
                shutil.rmtree(folder)
                dropped.append(s)
        return dropped

    def clone(self, stage: str, source: str, target: str) -> int:
        """A stage's rows under a new run id; refuses what is empty or unfinished."""
        m = self.manifest(stage, source)
        df = self.read(stage, source, m.fingerprint) if m else None
        if df is None or not m.complete or not (n := df.count()):
            raise ValueError(f"stage {stage} of run {source} is empty or not finished")
        df.write.mode("overwrite").parquet(str(self.path(stage, target, m.fingerprint)))
        self.put(Manifest(stage, target, m.fingerprint, m.expected, n, True, m.started, time.time()))
        return n

    def runs(self) -> list[str]:
        """Run ids, the latest first."""
        seen: dict[str, float] = {}
        for p in (self.root / "manifest").glob("*.json"):
            run = p.name.rsplit(".", 2)[0]
            seen[run] = max(seen.get(run, 0.0), p.stat().st_mtime)
        return sorted(seen, key=lambda r: (-seen[r], r))

    def archive(self, target: str, keep: int = 2, protect: tuple[str, ...] = (), dry_run: bool = True) -> list[str]:
        """Move all runs but the latest ``keep`` and the protected ones to ``target``; only says which on a dry run."""
        old = [r for r in self.runs()[keep:] if r not in protect]
        if not dry_run:
            for r in old:
                to = Path(target) / r
                to.mkdir(parents=True, exist_ok=True)
                for s in STAGES:
                    folder = self.root / f"stage={s}" / f"run_id={r}"
                    if folder.exists():
                        shutil.move(str(folder), str(to / f"stage={s}"))
                    if (p := self.manifest_path(s, r)).exists():
                        shutil.move(str(p), str(to / p.name))
        return old

    def status(self, run_id: str) -> list[dict]:
        """Records, expectation and times of each stage of a run."""
        out = []
        for s in STAGES:
            if m := self.manifest(s, run_id):
                out.append({"stage": s, "records": m.records, "expected": m.expected, "percent": round(100 * m.records / max(1, m.expected), 1), "complete": m.complete, "seconds": round(m.ended - m.started, 1), "errors": m.errors})
        return out


def fingerprints(parts: dict[str, dict], version: str, content: str = "") -> dict[str, str]:
    """A fingerprint per stage from its own model, backend, prompts and settings, and its upstream's; the first also knows the input's content.

    So a change of one classifier leaves all other stages as they are.
    """
    out: dict[str, str] = {}
    for s in STAGES:
        own, up = parts[s], UPSTREAM[s]
        settings = dict(own.get("settings") or {}) | ({} if up or not content else {"content": content})
        out[s] = fingerprint(s, own["model"], own["backend"], list(own["prompts"]), out[up] if up else None, version, settings or None)
    return out


def content_hash(items: DataFrame, columns: list[str]) -> str:
    """A hash of a table's content that doesn't depend on the order of rows."""
    h = F.xxhash64(*columns)
    row = items.agg(F.count("*").alias("n"), F.bit_xor(h).alias("x"), F.sum(F.pmod(h, F.lit(2**31))).alias("s")).first()
    return f"{row.n}-{row.x}-{row.s}"
