"""One table run: extract -> clean -> conform -> stage -> prep -> upsert -> rules -> snapshot.

The new core version appears as a whole or not at all. From the staged rows to the
new version it is one job; only rules that read their own table a second time get
a frozen copy of the upserted rows.

A table that the workspace keeps in buckets is rewritten bucket by bucket: a run covers the
buckets of the staged keys and, where a rule set looks things up, those of rows that look up
a row changed since the table's last version. All other buckets are named again as they are.
"""

from __future__ import annotations

import traceback
from collections.abc import Callable, Iterable, Mapping as MappingType, Sequence
from dataclasses import astuple, dataclass, field
from datetime import datetime
from functools import cache

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.operators.clean import clean_extract
from tallyloom.operators.conform import REFUSED, project_mapping, refused_cells, stamp_source, typed_select
from tallyloom.operators.numbering import assign_serials
from tallyloom.operators.skew import FLOOR, SHARE, heavy_keys
from tallyloom.operators.upsert import lacking, null_keys, one_per_key, upsert
from tallyloom.plans import prep
from tallyloom.plans.context import REMOTE_ID, Context, core_schema, instant, shaped
from tallyloom.plans.rules import FILLED, KEYS, READ_TWICE, STEADY, Reads, apply_rules
from tallyloom.plans.schedule import run_jobs, table_job
from tallyloom.session import freeze, scratch_scope
from tallyloom.sources.extracts import has_rows
from tallyloom.sources.landing import Landing
from tallyloom.sources.snapshots import Store, bucket_of
from tallyloom.spec import Mapping, Provider, TableFeed, quoted

# The providers whose staged rows feed prep steps, in their order.
PREP_PROVIDERS = ("upya", "upya_uganda")


@dataclass(frozen=True)
class Outcome:
    provider: str
    table: str
    status: str  # "written", "unchanged" or "failed"
    version: int | None = None
    message: str | None = None


@dataclass(frozen=True)
class Workspace:
    """The store, the mapping, and how core tables are read and written through them.

    ``buckets`` gives the number of buckets of the tables to be kept in buckets of their
    business key; about the size of the table by 256 MB is a good number.
    """

    store: Store
    mapping: Mapping
    remote_id: str = REMOTE_ID
    buckets: MappingType[str, int] = field(default_factory=dict)

    def core(self, table: str, version: int | None = None, buckets: Iterable[int] | None = None) -> DataFrame:
        """A core table, or some of its buckets, with all declared columns; empty before its first run."""
        schema = core_schema(self.mapping, table, self.remote_id)
        version = self.store.latest(table) if version is None else version
        if version is None:
            return shaped(self.store.spark.range(0).select(), schema)
        return shaped(self.store.read_core(table, version, buckets=buckets), schema)

    def in_buckets(self, table: str, version: int | None) -> bool:
        """Whether the version can be rewritten bucket by bucket."""
        if table not in self.buckets or version is None:
            return False
        layout = self.store.layout(table, version)
        return (layout.key, layout.buckets) == (self.mapping.business_key(table), self.buckets[table])

    def touched(self, table: str, keys: DataFrame, key: str, keyless: bool = False) -> list[int]:
        """Buckets of the keys: as many numbers as the table has buckets, at most.

        Keys are read as the table's type. ``keyless`` counts those that are null.
        """
        kind = core_schema(self.mapping, table, self.remote_id)[key].dataType
        typed = keys.select(F.col(quoted(key)).try_cast(kind).alias(key))
        if not keyless:
            typed = typed.where(F.col(quoted(key)).isNotNull())
        numbers = typed.select(bucket_of(key, self.buckets[table]).alias("b"))
        return sorted(r["b"] for r in numbers.distinct().collect())

    def write(
        self,
        table: str,
        df: DataFrame,
        after: int | None,
        touched: Iterable[int] | None = None,
        inputs: MappingType[str, int | None] | None = None,
    ) -> int:
        """The next version of a core table, in buckets if it is kept in buckets."""
        if table not in self.buckets:
            return self.store.write_core(table, df, after=after)
        key, serial = self.mapping.business_key(table), self.mapping.surrogate(table)
        kind = df.schema[serial].dataType.typeName() if serial in df.columns else ""
        tops = [serial] if kind in ("integer", "long", "short", "byte") else []
        return self.store.write_buckets(table, df, key, self.buckets[table], after, touched, tops, inputs)

    def change(
        self, table: str, version: int | None, keys: DataFrame, key: str, apply: Callable[[DataFrame], DataFrame]
    ) -> int:
        """``apply`` over the rows of some ``keys``, as the next version; it may add no rows."""
        if not self.in_buckets(table, version):
            return self.write(table, apply(self.core(table, version)), version)
        touched = self.touched(table, keys, key)
        done = apply(self.core(table, version, touched))
        # nothing that rules read has been read
        return self.write(table, done, version, touched, self.store.layout(table, version).inputs)

    def staged(self, provider: str, table: str) -> DataFrame | None:
        path = self.store.latest_staging(provider, table)
        return None if path is None else self.store.spark.read.parquet(path)

    def context(
        self, as_of: datetime, geo_parity: bool = False, hot=None, pins: MappingType[str, int | None] | None = None
    ) -> Context:
        """Inputs of rules; ``pins`` names the versions of tables to be read."""
        pins = pins or {}
        read = cache(lambda table: self.core(table, pins.get(table)))
        return Context(read, instant(as_of), self.remote_id, geo_parity, hot or {})


def conform_extract(
    extract: DataFrame, mapping: Mapping, provider: Provider, table: str
) -> DataFrame:
    """Cleaned, renamed and stamped staging rows, all text. One narrow stage."""
    feed = provider.tables.get(table, TableFeed())
    fields = mapping.resolve(table, provider.name)
    rows = project_mapping(clean_extract(extract), fields, provider.name, feed.geo_parity)
    return stamp_source(rows, provider)


def upsert_staged(
    ws: Workspace,
    core: DataFrame,
    staging: DataFrame,
    provider: Provider,
    table: str,
    as_of: datetime,
    top: int | None = None,
) -> DataFrame:
    """Reconcile one staged run into ``core``: typed, one row per key, serials for new rows.

    ``core`` may be the buckets of the staged keys; ``top`` is then the table's largest serial.
    """
    feed = provider.tables.get(table, TableFeed())
    key = ws.mapping.business_key(table)
    fields = ws.mapping.resolve(table, provider.name, system=True)
    staged = typed_select(
        staging.alias("a").filter(feed.filter) if feed.filter else staging, fields
    )
    rows = one_per_key(staged, key, [c for c in feed.order_by if c in staged.columns])
    serial = ws.mapping.surrogate(table)
    numbered = serial != key and serial not in rows.columns
    if numbered:
        serials = new_serials(core, staged, key, serial, top)
        rows = rows.join(serials, F.col(quoted(key)) == F.col("__fresh"), "left").drop("__fresh")
    merged = upsert(core.withColumn("__held", F.lit(True)), rows, key, instant(as_of), unique=True)
    # What the database defaults on insert: not archived, and the next serials.
    new = F.col("__held").isNull()
    filled = {"archived": F.when(new, F.lit(False)).otherwise(F.col("archived"))}
    if numbered:
        filled[serial] = F.when(new, F.col("__serial")).otherwise(F.col(quoted(serial)))
    return merged.withColumns(filled).drop("__held", "__serial")


def new_serials(core: DataFrame, staged: DataFrame, key: str, serial: str, top: int | None = None) -> DataFrame:
    """The next serial for each staged key that the core lacks, in key order."""
    keys = staged.selectExpr(f"{quoted(key)} AS __fresh").filter("__fresh IS NOT NULL")
    fresh = lacking(keys.distinct(), "__fresh", core, key)
    if top is None:
        top = core.agg(F.max(F.col(quoted(serial))).alias("top")).head()["top"] or 0
    numbered = assign_serials(fresh, "__serial", ["__fresh"], after=int(top))
    kind = core.schema[serial].dataType
    return numbered.select("__fresh", F.col("__serial").cast(kind).alias("__serial"))


def skewed_keys(
    ws: Workspace,
    core: DataFrame,
    staged: DataFrame,
    provider: Provider,
    table: str,
    rules: str,
) -> dict[str, list]:
    """Heavy values of the keys the rules join on, from both inputs of the upsert.

    What is heavy after the upsert was heavy in one of them, and both are stored
    tables, so only their key columns are read. Keys that a rule fills are left
    to ``filled_keys``.
    """
    keys = KEYS.get(rules, ())
    fields = [f for f in ws.mapping.resolve(table, provider.name, system=True) if f.name in keys]
    found = [heavy_keys(core, keys), heavy_keys(typed_select(staged, fields), keys)]
    return {k: sorted({v for hot in found for v in hot.get(k, [])}) for k in keys}


def filled_keys(rows: DataFrame, rules: str, ctx: Context, floor: int = FLOOR) -> dict[str, list]:
    """Heavy values of keys that one rule fills and a later one joins on.

    The rule is run over the columns it reads alone, and the sketch taken of what it fills.
    ``rows`` may hold a row as it was and as it is staged, hence half the share.
    """
    found: dict[str, list] = {}
    for column, rule in FILLED.get(rules, {}).items():
        if column in rows.columns:
            found.update(heavy_keys(rule(rows, ctx), [column], share=SHARE / 2, floor=floor))
    return found


def both_inputs(ws: Workspace, core: DataFrame, staged: DataFrame, provider: Provider, table: str) -> DataFrame | None:
    """Core and typed staged rows, one below the other: what is heavy after the upsert is so here, without its joins.

    None if the run lacks a column that the provider delivers: its rows are then part staged, part core.
    """
    feed = provider.tables.get(table, TableFeed())
    if any(f.name not in staged.columns for f in ws.mapping.resolve(table, provider.name)):
        return None
    fields = ws.mapping.resolve(table, provider.name, system=True)
    typed = typed_select(staged.alias("a").filter(feed.filter) if feed.filter else staged, fields)
    return core.unionByName(typed, allowMissingColumns=True)


def run_prep(ws: Workspace, provider: Provider, table: str) -> None:
    kind = provider.tables.get(table, TableFeed()).prep
    if kind == "core":
        staged = {
            (p, t): ws.staged(p, t) for p in PREP_PROVIDERS for t in ("stock", "accounts")
        }
        rows = [f for f in staged.values() if f is not None]
        accounts = [f for (_, t), f in staged.items() if t == "accounts" and f is not None]
        _rewrite(ws, "products", lambda df: prep.add_products(df, rows))
        _rewrite(ws, "pricing_groups", lambda df: prep.add_pricing_groups(df, accounts))
    elif kind == "users":
        for name, repair in (("users", prep.repair_users), ("webusers", prep.repair_webusers)):
            rows = [f for p in PREP_PROVIDERS if (f := ws.staged(p, name)) is not None]
            if rows and ws.store.has_core(name):
                _rewrite(ws, name, lambda df, repair=repair, rows=rows: repair(df, rows))


def _rewrite(ws: Workspace, table: str, change: Callable[[DataFrame], DataFrame]) -> None:
    version = ws.store.latest(table)
    ws.write(table, change(ws.core(table, version)), version)


def affected(
    ws: Workspace, table: str, version: int, reads: Reads, old: int | None, new: int | None
) -> DataFrame | None:
    """Keys of rows of ``table`` that look up a row which differs between two versions.

    Only the key columns of the table are scanned. None stands for all rows: there is no
    older version to compare with.
    """
    key = ws.mapping.business_key(table)
    if old == new:
        return ws.core(table, version, []).select(quoted(key))
    if old is None or new is None:
        return None
    changed = ws.store.changed_rows(reads.table, old, new, [*reads.on.values(), *reads.columns])
    changed = changed.select(*[F.col(quoted(c)).alias(f"__k{i}") for i, c in enumerate(reads.on.values())]).distinct()
    rows = ws.core(table, version).select(quoted(key), *map(quoted, reads.on))
    meets = [F.col(quoted(c)) == F.col(f"__k{i}") for i, c in enumerate(reads.on)]
    return rows.join(changed, meets, "left_semi").select(quoted(key))


def buckets_to_run(
    ws: Workspace,
    table: str,
    version: int | None,
    staged: DataFrame,
    rules: str | None,
    pins: MappingType[str, int | None],
) -> list[int] | None:
    """Buckets that a run of the table has to cover; None for the whole table."""
    if not ws.in_buckets(table, version) or (rules and rules not in STEADY):
        return None
    key = ws.mapping.business_key(table)
    touched = set(ws.touched(table, staged, key))
    before = ws.store.layout(table, version).inputs
    for reads in STEADY.get(rules, ()) if rules else ():
        if reads.table not in before:
            return None
        more = affected(ws, table, version, reads, before[reads.table], pins[reads.table])
        if more is None:
            return None
        touched.update(ws.touched(table, more, key, keyless=True))
    return sorted(touched)


def run_table(
    ws: Workspace,
    provider: Provider,
    table: str,
    extract: DataFrame,
    as_of: datetime,
    run: str,
) -> Outcome:
    """Reconcile one extract; an empty one leaves the table unchanged.

    Staged rows without a business key stay in staging and go no further.
    """
    if not has_rows(extract):
        return Outcome(provider.name, table, "unchanged", message="empty extract")
    feed = provider.tables.get(table, TableFeed())
    key = ws.mapping.business_key(table)
    rows = conform_extract(extract, ws.mapping, provider, table)
    if feed.set_aside:
        # judged while it is written; where nothing is refused, the column is empty and so dropped
        rows = rows.withColumn(REFUSED, refused_cells(rows, ws.mapping.resolve(table, provider.name, system=True)))
    staged = ws.store.write_staging(provider.name, table, run, rows)
    refused = 0
    if REFUSED in staged.columns:
        refused = _set_aside(ws, provider, table, run, staged, key)
        staged = staged.where(F.col(REFUSED).isNull()).drop(REFUSED)
    run_prep(ws, provider, table)
    if key not in staged.columns:
        return Outcome(provider.name, table, "failed", message=f"staging has no {key}")
    version = ws.store.latest(table)
    pins = {r.table: ws.store.latest(r.table) for r in STEADY.get(feed.rules, ())}
    with scratch_scope(ws.store.spark):
        touched = buckets_to_run(ws, table, version, staged, feed.rules, pins)
        core = ws.core(table, version, touched)
        top = None if touched is None else ws.store.layout(table, version).tops.get(ws.mapping.surrogate(table), 0)
        merged = upsert_staged(ws, core, staged, provider, table, as_of, top)
        if feed.rules:
            if feed.rules in READ_TWICE:
                merged = freeze(merged, f"upsert-{table}")
            hot = skewed_keys(ws, core, staged, provider, table, feed.rules)
            if feed.rules in FILLED and core.count() + staged.count() > FLOOR:
                rows = both_inputs(ws, core, staged, provider, table)
                filled = filled_keys(merged if rows is None else rows, feed.rules, ws.context(as_of, feed.geo_parity, hot, pins))
                hot = {k: sorted({*hot.get(k, []), *filled.get(k, [])}) for k in {*hot, *filled}}
            merged = apply_rules(merged, feed.rules, ws.context(as_of, feed.geo_parity, hot, pins))
        written = ws.write(table, merged, version, touched, pins)
    skipped = null_keys(staged, key).count()
    said = [f"{skipped} staged rows without {key}"] if skipped else []
    said += [f"{refused} staged rows set aside for cells of another type"] if refused else []
    return Outcome(provider.name, table, "written", written, "; ".join(said) or None)


def _set_aside(ws: Workspace, provider: Provider, table: str, run: str, staged: DataFrame, key: str) -> int:
    """Write the refused cells of a staged run, one row a cell; returns the number of rows they stand in."""
    own = F.col(quoted(key)) if key in staged.columns else F.lit(None).cast("string")
    rows = staged.where(F.col(REFUSED).isNotNull()).select(own.alias("key"), REFUSED)
    cells = rows.select("key", F.inline(REFUSED))
    path = ws.store.refused_path(provider.name, table, run)
    cells.write.mode("overwrite").parquet(path)
    return rows.count()


def refused(ws: Workspace, provider: Provider, table: str, run: str) -> DataFrame:
    """(key, column, value, type) of the cells that a run has set aside; empty if it has none."""
    path = ws.store.refused_path(provider.name, table, run)
    if not ws.store.complete(path):
        return ws.store.spark.createDataFrame([], "key string, column string, value string, type string")
    return ws.store.spark.read.parquet(path)


def run_landed(
    ws: Workspace, provider: Provider, table: str, landing: Landing, as_of: datetime, run: str, days: int = 7
) -> Outcome:
    """Reconcile the files of the last ``days`` days that no run has taken, and note them as taken.

    They are noted after the new version is published: a run that fails in between takes them
    once more, which changes nothing but ``change_timestamp``.
    """
    files = landing.pending(*landing.window(as_of, days))
    if not files:
        return Outcome(provider.name, table, "unchanged", message="nothing has landed")
    done = run_table(ws, provider, table, landing.read(files, provider.sep), as_of, run)
    if done.status != "failed":
        landing.take(files, run)
    return done


def run_all(
    ws: Workspace,
    providers: Sequence[Provider],
    extracts: Callable[[Provider, str], DataFrame],
    as_of: datetime,
    run: str,
    tables: Sequence[str] | None = None,
    parallel: int = 1,
) -> DataFrame:
    """Run every table of every provider; a failed one is recorded and the rest go on.

    With ``parallel`` above 1 runs that share no table overlap; results are those of one
    after the other.
    """
    chosen = [(provider, table) for provider in providers for table in tables or list(provider.tables)]
    jobs = []
    for provider, table in chosen:
        feed = provider.tables.get(table, TableFeed())
        jobs.append(table_job(provider.name, table, feed.prep, feed.rules))

    def work(i: int) -> Outcome:
        provider, table = chosen[i]
        try:
            return run_table(ws, provider, table, extracts(provider, table), as_of, run)
        except Exception as error:
            text = "".join(traceback.format_exception_only(error)).strip()
            return Outcome(provider.name, table, "failed", message=text)

    outcomes = [(run, *astuple(done)) for done in run_jobs(ws.store.spark, jobs, work, parallel)]
    log = ws.store.spark.createDataFrame(
        outcomes,
        "run string, provider string, table string, status string, version int, message string",
    ).withColumn("as_of", instant(as_of))
    ws.store.append_log("runs", log)
    return log
