"""Lookups: ``UPDATE t SET .. FROM d WHERE ..`` as a left join that never fans out.

The lookup side is cut to its keys and payload and reduced to one row per key
first, so a fact row is matched at most once; several candidates resolve to the
smallest payload. Rows without a match, or outside the guard, stay as they are.

Skew: fact rows whose key is null are scattered by a salt, since all null keys
would meet in one task. Values known to be hot can be passed in ``hot``: their
fact rows are spread over ``HOT_SPLITS`` salts and their single lookup row is
repeated once per salt. Sides small enough are broadcast by the planner from
their known size; nothing is broadcast by hint.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.spec import literal, quoted

HOT_SPLITS = 64
FOLD = 256  # rows of a hot key in one array
NULL_SPLITS = 4096

# A target is set from a lookup column, by name, or from an expression over them.
Payload = Callable[[str], Column]
Setter = str | Callable[[Payload], Column]


def lookup(
    facts: DataFrame,
    dim: DataFrame,
    on: Mapping[str, str],
    set: Mapping[str, Setter],
    *,
    when: Column | str | Callable[[Payload], Column] | None = None,
    only_null: str | None = None,
    dim_where: Column | str | None = None,
    carry: Sequence[str] = (),
    pick: Sequence[str] = (),
    row_key: Sequence[str] = (),
    hot: Sequence = (),
) -> DataFrame:
    """Set columns of ``facts`` from the row of ``dim`` with the same key.

    ``on`` maps fact columns to lookup columns. ``set`` maps targets to lookup
    columns or to expressions over the columns listed in ``carry``. ``when`` and
    ``only_null`` guard the fact row, ``dim_where`` the lookup rows. ``pick``
    orders the candidates of one key. ``row_key`` identifies a fact row and
    scatters rows without a key (default: all columns). ``hot`` lists heavy
    values of the first key column.
    """
    keys = [f"{quoted(d)} AS __k{i}" for i, d in enumerate(on.values())]
    keyed = _keyed(dim, keys, set, dim_where, carry, pick)
    return _apply(facts, keyed, list(on), set, when, only_null, row_key, hot)


def lookup_any_key(
    facts: DataFrame,
    fk: str,
    dim: DataFrame,
    keys: Sequence[str],
    set: Mapping[str, Setter],
    *,
    when: Column | str | Callable[[Payload], Column] | None = None,
    only_null: str | None = None,
    dim_where: Column | str | None = None,
    carry: Sequence[str] = (),
    pick: Sequence[str] = (),
    row_key: Sequence[str] = (),
    hot: Sequence = (),
) -> DataFrame:
    """Match ``fk`` against any of several key columns of ``dim``.

    The alternatives are unpivoted into one key column, which keeps this an
    equi-join; ``fk = a OR fk = b`` would compare every pair of rows.
    """
    either = f"explode(array({', '.join(quoted(k) for k in keys)})) AS __k0"
    keyed = _keyed(dim, [either], set, dim_where, carry, pick)
    return _apply(facts, keyed, [fk], set, when, only_null, row_key, hot)


def _keyed(dim, keys, set, dim_where, carry, pick) -> DataFrame:
    """The lookup side, cut to its keys and payload."""
    named = [s for s in set.values() if isinstance(s, str)]
    payload = dict.fromkeys([*pick, *named, *carry])
    if dim_where is not None:
        dim = dim.filter(dim_where)
    return dim.selectExpr(*keys, *[f"{quoted(c)} AS {quoted(f'__d_{c}')}" for c in payload])


def _one_per_key(keyed: DataFrame) -> DataFrame:
    """Smallest payload of each key; a single column needs no struct and hashes."""
    names = keyed.columns
    keys = [c for c in names if c.startswith("__k")]
    payload = [quoted(c) for c in names if c not in keys]
    keyed = keyed.filter(" AND ".join(f"{k} IS NOT NULL" for k in keys))
    if not payload:
        return keyed.distinct()
    if len(payload) == 1:
        return keyed.groupBy(*keys).agg(F.expr(f"min({payload[0]}) AS {payload[0]}"))
    smallest = keyed.groupBy(*keys).agg(F.expr(f"min(struct({', '.join(payload)})) AS __d"))
    return smallest.select(*keys, "__d.*")


def _apply(facts, keyed, fks, set, when, only_null, row_key, hot) -> DataFrame:
    # The salt is a join key on both sides. It scatters fact rows without a key
    # and those of hot keys, and gives both sides a shuffle of their own, without
    # which AQE does not split the partitions of keys nobody listed as hot. Its
    # plain value 0 is computed, since a literal would be folded out of the join.
    dim = _one_per_key(keyed)
    types = {f.name: f.dataType for f in facts.schema.fields}
    helpers = ["__salt", *dim.columns]
    row = f"xxhash64({', '.join(quoted(c) for c in (row_key or types))})"
    keyless = " OR ".join(f"{quoted(fk)} IS NULL" for fk in fks)
    spread, dim_salt = "", "cast(pmod(xxhash64(__k0), 1) AS int)"
    if hot:
        listed = ", ".join(literal(v) if isinstance(v, str) else str(v) for v in hot)
        spread = f"WHEN {quoted(fks[0])} IN ({listed}) THEN pmod({row}, {HOT_SPLITS})"
        dim_salt = (
            f"explode(CASE WHEN __k0 IN ({listed}) THEN sequence(0, {HOT_SPLITS - 1}) "
            "ELSE array(0) END)"
        )
    plain = f"pmod(xxhash64({quoted(fks[0])}), 1)"
    salt = f"CASE WHEN {keyless} THEN pmod({row}, {NULL_SPLITS}) + 1 {spread} ELSE {plain} END"
    meets = [f"cast({salt} AS int) = __salt"]
    meets += [f"{quoted(fk)} = __k{i}" for i, fk in enumerate(fks)]
    joined = facts.join(
        dim.selectExpr("*", f"{dim_salt} AS __salt"), F.expr(" AND ".join(meets)), "left"
    )

    def at_dim(name: str) -> Column:
        return F.col(quoted(f"__d_{name}"))

    guard = F.expr(
        "__k0 IS NOT NULL" + (f" AND {quoted(only_null)} IS NULL" if only_null else "")
    )
    if isinstance(when, Column | str):
        guard = guard & _as_column(when)
    elif when is not None:
        guard = guard & when(at_dim)

    out = {}
    for target, setter in set.items():
        value = at_dim(setter) if isinstance(setter, str) else setter(at_dim)
        if target in types:
            kept = F.col(quoted(target))
            out[target] = F.when(guard, value.cast(types[target])).otherwise(kept)
        else:
            out[target] = F.when(guard, value)
    return joined.withColumns(out).drop(*helpers)


def _as_column(when: Column | str) -> Column:
    return F.expr(when) if isinstance(when, str) else when


def recode(
    df: DataFrame,
    maps: DataFrame,
    columns: Mapping[str, str],
    key: Sequence[str],
    shared: bool = False,
) -> DataFrame:
    """Replace codes by the targets a code map gives for them.

    ``maps`` has ``col`` (which map), ``val`` and ``target``; ``columns`` maps a
    column of ``df`` to its map. An unmapped code stays, a code mapped to null
    becomes null, and a row with a null in ``key`` is left alone. With
    ``shared`` the key is not unique: a row whose own code is unmapped takes the
    target of another row of its key.
    """
    keyed = " AND ".join(f"{quoted(k)} IS NOT NULL" for k in key)
    out = df
    for column, name in columns.items():
        target, own = f"__target_{column}", f"__own_{column}"
        out = lookup(
            out.withColumns({target: F.expr("cast(NULL AS string)"), own: F.lit(False)}),
            maps.filter(F.col("col") == name),
            on={column: "val"},
            set={target: "target", own: lambda d: F.lit(True)},
            when=keyed,
            row_key=key,
        )
    if shared:
        groups = out.filter(_any_own(columns)).groupBy(*[F.col(quoted(k)).alias(k) for k in key])
        groups = groups.agg(
            *[F.min(F.col(quoted(f"__target_{c}"))).alias(f"__target_{c}") for c in columns],
            *[F.max(F.col(quoted(f"__own_{c}"))).alias(f"__own_{c}") for c in columns],
        )
        for c in columns:
            out = out.withColumn(f"__kin_{c}", F.lit(False))
        out = lookup(
            out,
            groups,
            on={k: k for k in key},
            set={
                **{f"__target_{c}": _own_first(c) for c in columns},
                **{f"__kin_{c}": f"__own_{c}" for c in columns},
            },
            carry=[f"__target_{c}" for c in columns],
            row_key=key,
        )
    done = {}
    for c in columns:
        hit = F.col(quoted(f"__own_{c}"))
        if shared:
            hit = hit | F.col(quoted(f"__kin_{c}"))
        done[c] = F.when(hit, F.col(quoted(f"__target_{c}"))).otherwise(F.col(quoted(c)))
    helpers = [f"__{part}_{c}" for c in columns for part in ("target", "own", "kin")]
    return out.withColumns(done).drop(*helpers)


def _any_own(columns: Mapping[str, str]) -> Column:
    found = F.lit(False)
    for c in columns:
        found = found | F.col(quoted(f"__own_{c}"))
    return found


def _own_first(column: str) -> Setter:
    own = F.col(quoted(f"__own_{column}"))
    target = F.col(quoted(f"__target_{column}"))
    return lambda d: F.when(own, target).otherwise(d(f"__target_{column}"))


def null_on_match(
    facts: DataFrame,
    dim: DataFrame,
    on: Mapping[str, str],
    target: str,
    *,
    dim_where: Column | str | None = None,
    row_key: Sequence[str] = (),
    hot: Sequence = (),
) -> DataFrame:
    """Clear ``target`` where its key meets a lookup row that passes ``dim_where``."""
    cleared = {target: lambda d: F.lit(None)}
    return lookup(facts, dim, on, cleared, dim_where=dim_where, row_key=row_key, hot=hot)


def join_every(
    left: DataFrame,
    right: DataFrame,
    on: tuple[str, str],
    row_key: Sequence[str],
    hot: Sequence = (),
) -> DataFrame:
    """Every pair of rows with equal keys, null keys aside.

    Rows of ``left`` under ``hot`` values are spread over salts by ``row_key``, the rows of
    ``right`` repeated once per salt. They come in arrays then: to unfold one costs less a
    pair than to match its rows one at a time.
    """
    rows = left.where(f"{quoted(on[0])} IS NOT NULL")
    if not hot:
        salted, meets = _salted(right, on, row_key, hot)
        return rows.join(salted, meets).drop("__salt")
    salted, meets = _salted(_folded(right, on[1], hot), (on[0], "__key"), row_key, hot)
    return rows.join(salted, meets).drop("__salt", "__key").select("*", F.inline("__rows")).drop("__rows")


def without_matches(
    left: DataFrame,
    right: DataFrame,
    on: tuple[str, str],
    row_key: Sequence[str],
    hot: Sequence = (),
) -> DataFrame:
    """Rows of ``left`` whose key no row of ``right`` has, spread like those of ``join_every``."""
    salted, meets = _salted(right, on, row_key, hot)
    return left.join(salted, meets, "left_anti")


def _salt(key: str, row_key: Sequence[str], hot: Sequence) -> str:
    row = f"xxhash64({', '.join(quoted(c) for c in row_key)})"
    return f"CASE WHEN {quoted(key)} IN ({_listed(hot)}) THEN pmod({row}, {HOT_SPLITS}) ELSE 0 END"


def _listed(values: Sequence) -> str:
    return ", ".join(literal(v) if isinstance(v, str) else str(v) for v in values)


def _folded(right: DataFrame, key: str, hot: Sequence) -> DataFrame:
    """The rows of ``right`` with a key as ``__key`` and arrays ``__rows``, those of ``hot`` keys up to ``FOLD`` together."""
    keyed = right.where(f"{quoted(key)} IS NOT NULL").select(F.col(quoted(key)).alias("__key"), F.struct("*").alias("__row"))
    listed = f"__key IN ({_listed(hot)})"
    # numbered and collected in the same task
    number = f"(row_number() OVER (PARTITION BY __key ORDER BY __key) - 1) div {FOLD}"
    groups = keyed.where(listed).selectExpr("*", f"{number} AS __group").groupBy("__key", "__group")
    folded = groups.agg(F.collect_list("__row").alias("__rows")).drop("__group")
    return folded.union(keyed.where(f"NOT {listed}").select("__key", F.array("__row")))


def _salted(right: DataFrame, on: tuple[str, str], row_key: Sequence[str], hot: Sequence) -> tuple[DataFrame, Column]:
    """The rows of ``right`` with a key, once per salt, and the condition on which rows meet them."""
    mine, theirs = map(quoted, on)
    # without hot values the salt still keeps the join from reusing a shuffle that AQE cannot split
    salt, salts = f"pmod(xxhash64({mine}), 1)", f"array(pmod(xxhash64({theirs}), 1))"
    if hot:
        salt = _salt(on[0], row_key, hot)
        salts = f"CASE WHEN {theirs} IN ({_listed(hot)}) THEN sequence(0L, {HOT_SPLITS - 1}L) ELSE array(0L) END"
    salted = right.where(f"{theirs} IS NOT NULL").selectExpr("*", f"explode({salts}) AS __salt")
    return salted, F.expr(f"{salt} = __salt AND {mine} = {theirs}")


def set_if_exists(
    df: DataFrame, other: DataFrame, set: Mapping[str, Column], when: Column
) -> DataFrame:
    """Conditional overwrite that applies only if ``other`` has any row.

    The test is a scalar subquery over one row, not a join.
    """
    present = other.limit(1).agg(F.count(F.lit(1)) > 0).scalar()
    guard = when & present
    return df.withColumns({t: F.when(guard, v).otherwise(F.col(quoted(t))) for t, v in set.items()})


def repair_identity(
    df: DataFrame,
    provider: DataFrame,
    on: Mapping[str, str],
    differs: str,
    set: Sequence[str],
    row_key: Sequence[str] = (),
) -> DataFrame:
    """Take ``set`` from the provider where ``differs`` is not equal (null never differs)."""
    return lookup(
        df,
        provider,
        on,
        {c: c for c in set},
        when=lambda d: F.col(quoted(differs)) != d(differs),
        carry=[differs],
        pick=[differs],
        row_key=row_key,
    )


def write_back(
    core: DataFrame, ids: DataFrame, key: str, remote_id: str = "remote_id", id_col: str = "ID"
) -> DataFrame:
    """Set the remote identifier of the rows an id map names, in one join."""
    return lookup(
        core,
        ids,
        {key: key},
        {remote_id: lambda d: d(id_col).cast("bigint")},
        dim_where=F.col(quoted(id_col)).isNotNull(),
        carry=[id_col],
        row_key=[key],
    )
