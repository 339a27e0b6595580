"""Mart refresh with explicit dependencies.

Jobs run in dependency order; a failing job does not stop the others, but
every job that depends on it (directly or not) is skipped instead of running
on stale inputs.  The run raises at the end when anything failed.

With a run log a repeated run resumes: a job that succeeded for the same day, whose input files and
output files are still those of that run, is not run again.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import json
import traceback
from collections.abc import Callable
from dataclasses import dataclass, field


@dataclass
class Job:
    name: str
    run: Callable[[dt.date], object]
    deps: tuple[str, ...] = ()
    reads: tuple[str, ...] = ()        # paths: what a run log compares
    writes: tuple[str, ...] = ()


@dataclass
class RunReport:
    ok: list[str] = field(default_factory=list)
    failed: dict[str, str] = field(default_factory=dict)
    skipped: dict[str, str] = field(default_factory=dict)
    reused: list[str] = field(default_factory=list)


class RunLog:
    """One small file per (job, day) in ``path``: digests of the files the job read and wrote when it succeeded."""

    def __init__(self, spark, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")

    def _state(self, paths: tuple[str, ...]) -> str:
        from martcraft.sinks import lake
        states = [lake.file_states(self.spark, p) for p in paths]
        return hashlib.sha256(json.dumps(states).encode()).hexdigest()

    def _file(self, job: Job, as_of: dt.date) -> str:
        return f"{self.path}/{job.name}-{as_of.isoformat()}.json"

    def begin(self, job: Job) -> str:
        """The inputs' state, taken before the job reads them."""
        return self._state(job.reads)

    def done(self, job: Job, as_of: dt.date) -> bool:
        """Whether the job's last success for the day still stands.  A job without declared outputs always runs."""
        from martcraft.sinks import lake
        text = lake.read_text(self.spark, self._file(job, as_of)) if job.writes else None
        return text is not None and json.loads(text) == {"reads": self._state(job.reads), "writes": self._state(job.writes)}

    def record(self, job: Job, as_of: dt.date, reads: str) -> None:
        from martcraft.sinks import lake
        lake.write_text(self.spark, self._file(job, as_of), json.dumps({"reads": reads, "writes": self._state(job.writes)}))


class RefreshFailed(RuntimeError):
    def __init__(self, report: RunReport):
        super().__init__(f"failed={sorted(report.failed)} skipped={sorted(report.skipped)}")
        self.report = report


def order_jobs(jobs: list[Job]) -> list[Job]:
    by_name = {j.name: j for j in jobs}
    for j in jobs:
        for d in j.deps:
            if d not in by_name:
                raise ValueError(f"{j.name} depends on unknown job {d}")
    done, out, visiting = set(), [], set()

    def visit(j: Job):
        if j.name in done:
            return
        if j.name in visiting:
            raise ValueError(f"dependency cycle at {j.name}")
        visiting.add(j.name)
        for d in j.deps:
            visit(by_name[d])
        visiting.discard(j.name)
        done.add(j.name)
        out.append(j)

    for j in jobs:                      # stable: declaration order where free
        visit(j)
    return out


def run_all(jobs: list[Job], as_of: dt.date, raise_on_failure: bool = True, log: RunLog | None = None) -> RunReport:
    rep = RunReport()
    bad: set[str] = set()
    for j in order_jobs(jobs):
        blocked = [d for d in j.deps if d in bad]
        if blocked:
            rep.skipped[j.name] = f"upstream failed: {', '.join(blocked)}"
            bad.add(j.name)
            continue
        try:
            if log is not None and log.done(j, as_of):
                rep.reused.append(j.name)
                continue
            reads = log.begin(j) if log is not None else ""
            j.run(as_of)
            if log is not None:
                log.record(j, as_of, reads)
            rep.ok.append(j.name)
        except Exception as e:  # noqa: BLE001 - collected and re-raised at the end
            rep.failed[j.name] = f"{type(e).__name__}: {e}\n{traceback.format_exc(limit=3)}"
            bad.add(j.name)
    if raise_on_failure and (rep.failed or rep.skipped):
        raise RefreshFailed(rep)
    return rep
