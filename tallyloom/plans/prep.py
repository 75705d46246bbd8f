"""Steps before the upsert: reference tables and repaired identities."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from tallyloom.operators.aggregate import new_member_pairs, new_members
from tallyloom.operators.lookup import repair_identity


def _with(frames: Sequence[DataFrame], *columns: str) -> list[DataFrame]:
    return [f for f in frames if all(c in f.columns for c in columns)]


def add_products(products: DataFrame, staged: Sequence[DataFrame]) -> DataFrame:
    """Products that staged stock or accounts name and the table lacks."""
    sources = _with(staged, "product")
    if not sources:
        return products
    names = {"product": "product", "product_external_name": "product"}
    return new_members(products, sources, "product", names)


def add_pricing_groups(groups: DataFrame, staged_accounts: Sequence[DataFrame]) -> DataFrame:
    """Pricing groups of staged accounts, provider by provider."""
    sources = _with(staged_accounts, "product", "pricing_group")
    return new_member_pairs(groups, sources, "pricing_group", ("product", "pricing_group"))


def repair_users(users: DataFrame, staged: Sequence[DataFrame]) -> DataFrame:
    """Email and name of users whose provider now gives another email."""
    for rows in _with(staged, "user_upya_id", "user_email", "username"):
        users = repair_identity(
            users,
            rows,
            {"user_upya_id": "user_upya_id"},
            differs="user_email",
            set=("user_email", "username"),
            row_key=["user_id"],
        )
    return users


def repair_webusers(webusers: DataFrame, staged: Sequence[DataFrame]) -> DataFrame:
    for rows in _with(staged, "webuser_upya_id", "webuser_email", "webuser_username"):
        webusers = repair_identity(
            webusers,
            rows,
            {"webuser_upya_id": "webuser_upya_id"},
            differs="webuser_email",
            set=("webuser_email", "webuser_username"),
            row_key=["webuser_email"],
        )
    return webusers
