"""Post-upsert rules per table, in the order in which they depend on each other.

Each rule takes the table and returns it with the same rows. Rules that look up
the same row are one join; guards that differ are put into the expressions.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.functions import cells
from tallyloom.operators.aggregate import count_fill
from tallyloom.operators.derive import account_figures, set_where
from tallyloom.operators.lookup import join_every, lookup, lookup_any_key, null_on_match, recode, set_if_exists, without_matches
from tallyloom.plans.context import Context, Rule

# Provider names, codes and dates the rules test.
FIRST, SECOND, THIRD = "angaza", "upya", "upya_uganda"
BOTH = "angaza and upya"
DETACHED = ("DETACHED", "WRITTEN_OFF")
PENDING, APPROVED, DEPLOYED, REPLACED = "APPROVAL_PENDING", "APPROVED", "DEPLOYED", "REPLACED"
RESPONSIBLE_SINCE = "2020-02-22"
UNIT_PATTERN = "[0-9]{8}"

USER_KEYS = ("user_angaza_id", "user_upya_id")
WEBUSER_KEYS = ("webuser_angaza_id", "webuser_upya_id")


def _user(df: DataFrame, ctx: Context, fk: str, row_key: str, **sets: str) -> DataFrame:
    """Set columns from the user whose identifier, at either provider, is ``fk``.

    ``user_id`` and ``full_name`` are always carried, so all lookups of one
    table share one reduced user side. Where only the identifier is set, users
    without one are no candidates.
    """
    only_id = set(sets.values()) == {"user_id"}
    return lookup_any_key(
        df,
        fk,
        ctx.table("users"),
        USER_KEYS,
        sets,
        carry=["user_id", "full_name"],
        dim_where="user_id IS NOT NULL" if only_id else None,
        pick=["user_id"],
        row_key=[row_key],
        hot=ctx.heavy(fk),
    )


def _country(row_key: str, only_null: bool) -> Rule:
    def rule(df: DataFrame, ctx: Context) -> DataFrame:
        return lookup(
            df,
            ctx.table("country"),
            {"country": "country_name"},
            {"country_id": "country_id"},
            only_null="country_id" if only_null else None,
            row_key=[row_key],
        )

    return rule


# -- accounts ---------------------------------------------------------------

ACCOUNT = "account_external_id"


def account_codes(df: DataFrame, ctx: Context) -> DataFrame:
    codes = {"account_status": "ACCOUNT_STATUS", "product": "PRODUCT"}
    return recode(df, ctx.table("columnmaps"), codes, key=[ACCOUNT])


def account_amounts(df: DataFrame, ctx: Context) -> DataFrame:
    return account_figures(df, ctx.as_of, disabled_for=SECOND)


def account_payments(df: DataFrame, ctx: Context) -> DataFrame:
    """A count of 0 also where the account has no identifier; null systems are left."""
    return count_fill(
        df,
        ctx.table("payments"),
        ACCOUNT,
        "number_of_payments",
        when=F.col("external_sys") != FIRST,
        row_key=["account_id"],
    )


def account_client(df: DataFrame, ctx: Context) -> DataFrame:
    return lookup(
        df,
        ctx.table("clients"),
        {"client_external_id": "client_external_id"},
        {"client_id": "client_id"},
        only_null="client_id",
        row_key=[ACCOUNT],
        hot=ctx.heavy("client_external_id"),
    )


def account_stock(df: DataFrame, ctx: Context) -> DataFrame:
    return lookup(
        df,
        ctx.table("stock"),
        {"asset_number": "asset_number", "external_sys": "external_sys"},
        {"stock_id": "stock_id"},
        only_null="stock_id",
        row_key=[ACCOUNT],
        hot=ctx.heavy("asset_number"),
    )


def account_unit(df: DataFrame, ctx: Context) -> DataFrame:
    """The asset number stands in for a missing unit number, once there are users."""
    return set_if_exists(
        df,
        ctx.table("users"),
        {"unit_number": F.col("asset_number")},
        when=F.col("unit_number").isNull()
        & F.col("asset_number").isNotNull()
        & ~F.col("account_status").isin(*DETACHED),
    )


def account_detached(df: DataFrame, ctx: Context) -> DataFrame:
    return set_where(
        df, F.col("account_status").isin(*DETACHED), stock_id=None, unit_number=None
    )


def account_application(df: DataFrame, ctx: Context) -> DataFrame:
    return lookup(
        df,
        ctx.table("applications"),
        {ACCOUNT: ACCOUNT},
        {
            "application_id": "application_id",
            "application_external_id": "application_external_id",
        },
        only_null="application_id",
        row_key=["account_id"],
    )


def account_users(df: DataFrame, ctx: Context) -> DataFrame:
    df = _user(
        df,
        ctx,
        "registering_user_external_id",
        ACCOUNT,
        registering_user_id="user_id",
        registering_user="full_name",
    )
    return _user(
        df,
        ctx,
        "responsible_user_external_id",
        ACCOUNT,
        responsible_user_id="user_id",
        responsible_user="full_name",
    )


# -- applications -----------------------------------------------------------

APPLICATION = "application_external_id"


def application_codes(df: DataFrame, ctx: Context) -> DataFrame:
    return recode(
        df, ctx.table("columnmaps"), {"status": "APPLICATION_STATUS"}, key=[APPLICATION]
    )


def application_status(df: DataFrame, ctx: Context) -> DataFrame:
    """Tests the account identifier as it was staged, so before it is filled."""
    lone = (F.col("external_sys") == THIRD) & F.col(ACCOUNT).isNull()
    df = set_where(df, lone, account_status=None)
    pending = F.col(ACCOUNT).isNotNull() & (F.col("status") == PENDING)
    return set_where(df, pending, status=F.lit(APPROVED))


def application_account_key(df: DataFrame, ctx: Context) -> DataFrame:
    return lookup(
        df,
        ctx.table("accounts"),
        {APPLICATION: ACCOUNT},
        {ACCOUNT: ACCOUNT},
        row_key=["application_id"],
    )


def application_account(df: DataFrame, ctx: Context) -> DataFrame:
    deployed = (F.col("external_sys") == SECOND) & (F.col("status") == DEPLOYED)
    return lookup(
        df,
        ctx.table("accounts"),
        {ACCOUNT: ACCOUNT},
        {
            "account_id": "account_id",
            "unit_number": lambda d: F.when(deployed, d("unit_number")).otherwise(
                F.col("unit_number")
            ),
        },
        carry=["unit_number"],
        row_key=[APPLICATION],
        hot=ctx.heavy(ACCOUNT),
    )


def application_users(df: DataFrame, ctx: Context) -> DataFrame:
    df = _user(df, ctx, "recorder_ext_id", APPLICATION, recorder_id="user_id", recorder="full_name")
    df = lookup_any_key(
        df,
        "note_recorder_external_id",
        ctx.table("webusers"),
        WEBUSER_KEYS,
        {"note_recorder": "webuser_fullname", "note_recorder_id": "webuser_id"},
        only_null="note_recorder_id",
        dim_where="webuser_id IS NOT NULL",
        pick=["webuser_id"],
        row_key=[APPLICATION],
        hot=ctx.heavy("note_recorder_external_id"),
    )
    return _user(df, ctx, "responsible_user_ext_id", APPLICATION, responsible_user_id="user_id")


# -- clients ----------------------------------------------------------------

CLIENT = "client_external_id"


def client_phone(df: DataFrame, ctx: Context) -> DataFrame:
    name = "next_of_kin_contact_number"
    return df.withColumn(name, cells.phone_digits(F.col(name)))


def client_location(df: DataFrame, ctx: Context) -> DataFrame:
    point = F.col("client_location_lnglat")
    missing = F.col("client_latitude").isNull() | F.col("client_longitude").isNull()
    return set_where(
        df,
        missing,
        client_latitude=cells.latitude(point, ctx.geo_parity),
        client_longitude=cells.longitude(point, ctx.geo_parity),
    )


def client_user(df: DataFrame, ctx: Context) -> DataFrame:
    return _user(df, ctx, "responsible_user_external_id", CLIENT, responsible_user_id="user_id")


# -- payments ---------------------------------------------------------------

PAYMENT = "payment_external_id"


def payment_account(df: DataFrame, ctx: Context) -> DataFrame:
    """Four updates from the payment's account, each with its own guard, as one join.

    The pricing group is overwritten only where the payment already has one.
    """
    since = F.lit(RESPONSIBLE_SINCE).cast("timestamp")
    unassigned = F.col("responsible_user_id").isNull() & (F.col("effective_utc") >= since)

    def where(guard, target, source):
        return lambda d: F.when(guard, d(source)).otherwise(F.col(target))

    return lookup(
        df,
        ctx.table("accounts"),
        {ACCOUNT: ACCOUNT},
        {
            "account_id": where(F.col("account_id").isNull(), "account_id", "account_id"),
            "unit_number": where(F.col("unit_number").isNull(), "unit_number", "unit_number"),
            "pricing_group": where(
                F.col("pricing_group").isNotNull(), "pricing_group", "pricing_group"
            ),
            "responsible_user_id": where(unassigned, "responsible_user_id", "responsible_user_id"),
            "responsible_user_ext_id": where(
                unassigned, "responsible_user_ext_id", "responsible_user_external_id"
            ),
        },
        carry=[
            "account_id",
            "unit_number",
            "pricing_group",
            "responsible_user_id",
            "responsible_user_external_id",
        ],
        row_key=[PAYMENT],
        hot=ctx.heavy(ACCOUNT),
    )


def payment_user(df: DataFrame, ctx: Context) -> DataFrame:
    system = F.col("external_sys")
    return lookup(
        df,
        ctx.table("users"),
        {"responsible_user_id": "user_id"},
        {
            "responsible_user": "username",
            "responsible_user_ext_id": lambda d: F.when(
                system == FIRST, d("user_angaza_id")
            ).when(system == SECOND, d("user_upya_id")),
        },
        only_null="responsible_user",
        carry=["user_angaza_id", "user_upya_id"],
        row_key=[PAYMENT],
        hot=ctx.heavy("responsible_user_id"),
    )


# -- stock ------------------------------------------------------------------

STOCK = "stock_external_id"
ASSET = ("asset_number", "external_sys")


def stock_codes(df: DataFrame, ctx: Context) -> DataFrame:
    codes = {"product": "PRODUCT", "transit_state": "TRANSIT_STATE"}
    return recode(df, ctx.table("columnmaps"), codes, key=ASSET, shared=True)


def stock_account(df: DataFrame, ctx: Context) -> DataFrame:
    return lookup(
        df,
        ctx.table("accounts"),
        {k: k for k in ASSET},
        {"account_id": "account_id"},
        row_key=[STOCK],
        hot=ctx.heavy("asset_number"),
    )


def stock_detached(df: DataFrame, ctx: Context) -> DataFrame:
    """Tests the account also where the rule before has just filled it."""
    return null_on_match(
        df,
        ctx.table("accounts"),
        {"account_id": "account_id"},
        "account_id",
        dim_where="asset_number IS NULL",
        row_key=[STOCK],
        hot=ctx.heavy("account_id"),
    )


def stock_holder(df: DataFrame, ctx: Context) -> DataFrame:
    return _user(df, ctx, "holder_external_id", STOCK, holder_id="user_id")


# -- users, account events --------------------------------------------------


def user_system(df: DataFrame, ctx: Context) -> DataFrame:
    both = F.col("user_upya_id").isNotNull() & F.col("user_angaza_id").isNotNull()
    return set_where(df, both, external_sys=F.lit(BOTH))


def event_replaced_unit(df: DataFrame, ctx: Context) -> DataFrame:
    open_ = (
        (F.col("event_type") == REPLACED)
        & F.col("replaced_unit_number").isNull()
        & F.col(ctx.remote_id).isNull()
    )
    unit = cells.first_match(F.col("event_info"), UNIT_PATTERN)
    return set_where(df, open_, replaced_unit_number=unit)


# -- replacements -----------------------------------------------------------

REPLACEMENT = "replacement_external_id"


def _replacement_stock(which: str) -> Rule:
    def rule(df: DataFrame, ctx: Context) -> DataFrame:
        return lookup(
            df,
            ctx.table("stock"),
            {f"{which}_unit_number": "unit_number"},
            {f"{which}_stock_id": "stock_id", f"{which}_asset_number": "asset_number"},
            dim_where=F.col("external_sys") != SECOND,
            pick=["stock_id"],
            row_key=[REPLACEMENT],
        )

    return rule


def replacement_account(df: DataFrame, ctx: Context) -> DataFrame:
    """Takes the account of the new asset; accounts that have an identifier are passed over."""
    return lookup(
        df,
        ctx.table("accounts"),
        {"new_asset_number": "asset_number"},
        {"account_id": "account_id"},
        dim_where="unit_number IS NOT NULL AND account_id IS NULL",
        row_key=[REPLACEMENT],
    )


def replacement_users(df: DataFrame, ctx: Context) -> DataFrame:
    df = _user(df, ctx, "responsible_user_ext_id", REPLACEMENT, responsible_user_id="user_id")
    return _user(
        df, ctx, "acc_responsible_user_ext_id", REPLACEMENT, acc_responsible_user_id="user_id"
    )


def derive_replacements(
    accounts: DataFrame, stock: DataFrame, replacements: DataFrame, hot: Sequence = ()
) -> DataFrame:
    """Replacement events implied by accounts that name a previous unit.

    One row per account and live stock item of that unit, unless the event is
    already recorded. All of them: there is no row limit. ``hot`` lists unit
    numbers that very many accounts name (``heavy_keys`` finds them).
    """
    old = stock.filter(F.col("archived") == F.lit(False)).select(
        F.col("stock_id").alias("old_stock_id"),
        F.col("unit_number").alias("old_unit_number"),
        F.col("asset_number").alias("old_asset_number"),
    )
    moved = accounts.filter(
        F.col("date_of_replacement_utc").isNotNull() & F.col("previous_unit_number").isNotNull()
    ).withColumn(REPLACEMENT, F.concat(F.lit("R"), F.col("previous_unit_number")))
    known = replacements.select(F.col(REPLACEMENT).alias("__known"))
    # spread here already: what follows may multiply the rows where they are
    fresh = without_matches(moved, known, (REPLACEMENT, "__known"), ["account_id"], [f"R{v}" for v in hot])
    pairs = join_every(fresh, old, ("previous_unit_number", "old_unit_number"), ["account_id"], hot)
    return pairs.select(
        REPLACEMENT,
        "external_sys",
        "product",
        "account_id",
        "old_stock_id",
        "old_unit_number",
        "old_asset_number",
        F.col("stock_id").alias("new_stock_id"),
        F.col("unit_number").alias("new_unit_number"),
        F.col("asset_number").alias("new_asset_number"),
        F.col("date_of_replacement_utc").alias("replacement_date_utc"),
        F.lit("WEB").alias("source_of_replacement"),
        F.col("responsible_user").alias("acc_responsible_user"),
        F.col("responsible_user_id").alias("acc_responsible_user_id"),
        F.col("responsible_user_external_id").alias("acc_responsible_user_ext_id"),
    )


RULES: dict[str, Sequence[Rule]] = {
    # Codes come before the rules that test them; a missing unit number is filled
    # before detached accounts lose theirs. Payments and applications meet on the
    # same key, one after the other, so that one shuffle of the accounts serves both.
    "accounts": (
        account_codes,
        account_amounts,
        account_payments,
        account_application,
        account_client,
        account_stock,
        account_unit,
        account_detached,
        account_users,
        _country(ACCOUNT, only_null=True),
    ),
    "applications": (
        application_codes,
        application_status,
        application_account_key,
        application_account,
        application_users,
        _country(APPLICATION, only_null=False),
    ),
    "clients": (client_phone, client_location, client_user, _country(CLIENT, only_null=False)),
    "payments": (payment_account, payment_user, _country(PAYMENT, only_null=True)),
    "stock": (stock_codes, stock_account, stock_detached, stock_holder, _country(STOCK, only_null=False)),
    "users": (user_system,),
    "account_events": (event_replaced_unit,),
    "replacements": (
        replacement_account,
        _replacement_stock("new"),
        _replacement_stock("old"),
        replacement_users,
    ),
}

# Rule sets that join a table with itself.
READ_TWICE = ("stock",)

# Foreign keys that rules join on and that heavy values may skew.
KEYS: dict[str, Sequence[str]] = {
    "accounts": (
        "client_external_id",
        "asset_number",
        "registering_user_external_id",
        "responsible_user_external_id",
    ),
    "applications": (
        ACCOUNT,
        "recorder_ext_id",
        "note_recorder_external_id",
        "responsible_user_ext_id",
    ),
    "clients": ("responsible_user_external_id",),
    "payments": (ACCOUNT, "responsible_user_id"),
    "stock": ("asset_number", "account_id", "holder_external_id"),
    "replacements": ("responsible_user_ext_id", "acc_responsible_user_ext_id"),
}


# Keys of a lookup that an earlier rule of the set fills, and that rule: values may be heavy
# after it that were heavy in no input.
FILLED: dict[str, Mapping[str, Rule]] = {
    "applications": {ACCOUNT: application_account_key},
    "payments": {"responsible_user_id": payment_account},
    "stock": {"account_id": stock_account},
}


@dataclass(frozen=True)
class Reads:
    """What a rule set takes from another table: rows by ``on`` (own column: its column)."""

    table: str
    on: Mapping[str, str]
    columns: Sequence[str]


# Rule sets whose result for a row follows from the row and the rows it looks up, and that
# change nothing when they are run again over the same inputs: a run need only cover rows
# that are staged or that look up a changed row. Not so where time passes (accounts), where a
# second run goes on from what the first one has left (applications, clients, replacements), or
# where rows of one table meet each other (stock).
STEADY: dict[str, Sequence[Reads]] = {
    "payments": (
        Reads(
            "accounts",
            {ACCOUNT: ACCOUNT},
            ("account_id", "unit_number", "pricing_group", "responsible_user_id", "responsible_user_external_id"),
        ),
        Reads("users", {"responsible_user_id": "user_id"}, ("username", "user_angaza_id", "user_upya_id")),
        Reads("country", {"country": "country_name"}, ("country_id",)),
    ),
    "users": (),
    "account_events": (),
}


def apply_rules(df: DataFrame, table: str, ctx: Context) -> DataFrame:
    for rule in RULES.get(table, ()):
        df = rule(df, ctx)
    return df
