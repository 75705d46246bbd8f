"""Which table runs may overlap, and running them so.

Runs are listed in the order in which they would be done one after the other. A run waits for
an earlier one if either writes a table that the other reads or writes. So every run sees the
same versions as in that order, and the result is the same; runs without such a tie overlap.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import FIRST_COMPLETED, Future, ThreadPoolExecutor, wait
from dataclasses import dataclass, field
from typing import TypeVar

from pyspark.sql import SparkSession

# Tables that each rule set looks things up in.
RULE_READS = {
    "accounts": ("columnmaps", "payments", "applications", "clients", "stock", "users", "country"),
    "applications": ("columnmaps", "accounts", "users", "webusers", "country"),
    "clients": ("users", "country"),
    "payments": ("accounts", "users", "country"),
    "stock": ("columnmaps", "accounts", "users", "country"),
    "replacements": ("accounts", "stock", "users"),
}
# What prep steps read in staging, and which tables they rewrite.
PREP_READS = {"core": ("staged stock", "staged accounts"), "users": ("staged users", "staged webusers")}
PREP_WRITES = {"core": ("products", "pricing_groups"), "users": ("users", "webusers")}


@dataclass(frozen=True)
class Job:
    """One run: its name, and the tables it reads and writes."""

    name: str
    reads: frozenset[str] = field(default_factory=frozenset)
    writes: frozenset[str] = field(default_factory=frozenset)


def table_job(provider: str, table: str, prep: str | None, rules: str | None) -> Job:
    """The run of one table of one provider."""
    reads = {table, *RULE_READS.get(rules or "", ()), *PREP_READS.get(prep or "", ())}
    writes = {table, f"staged {table}", *PREP_WRITES.get(prep or "", ())}
    return Job(f"{provider}.{table}", frozenset(reads), frozenset(writes))


def waits_for(jobs: Sequence[Job]) -> list[set[int]]:
    """For each job the earlier ones that it has to wait for."""
    out: list[set[int]] = []
    for i, job in enumerate(jobs):
        tied = {
            j
            for j, before in enumerate(jobs[:i])
            if before.writes & (job.reads | job.writes) or before.reads & job.writes
        }
        out.append(tied)
    return out


T = TypeVar("T")


def run_jobs(spark: SparkSession, jobs: Sequence[Job], work: Callable[[int], T], parallel: int) -> list[T]:
    """``work(i)`` for every job, at most ``parallel`` at a time; results in the order of the jobs.

    Each job gets a scheduler pool of its name, which shares the cluster evenly among running
    ones where ``spark.scheduler.mode`` is FAIR. ``work`` must not raise.
    """
    ties = waits_for(jobs)
    done: dict[int, T] = {}
    running: dict[Future[T], int] = {}
    open_ = list(range(len(jobs)))

    def in_pool(i: int) -> T:
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", jobs[i].name)
        try:
            return work(i)
        finally:
            spark.sparkContext.setLocalProperty("spark.scheduler.pool", None)

    with ThreadPoolExecutor(max_workers=parallel) as threads:
        while open_ or running:
            for i in [i for i in open_ if ties[i] <= done.keys()][: parallel - len(running)]:
                running[threads.submit(in_pool, i)] = i
                open_.remove(i)
            for future in wait(running, return_when=FIRST_COMPLETED).done:
                done[running.pop(future)] = future.result()
    return [done[i] for i in range(len(jobs))]
