"""Deterministic identifiers."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def content_sha256(body: Column) -> Column:
    return F.sha2(body, 256)


def stable_id(*parts: Column, prefix: str = "", length: int = 24) -> Column:
    """Hash of the joined parts; NULL counts as an empty part so ids never vanish."""
    joined = F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])
    return F.concat(F.lit(prefix), F.substring(F.sha2(joined, 256), 1, length))


def task_id(payload: Column) -> Column:
    """Identifier of a task struct: its JSON text, hashed."""
    return F.substring(F.sha2(F.to_json(payload), 256), 1, 24)


def seeded_rank(seed: int, key: Column, label: str = "") -> Column:
    """Order key that depends only on the seed and the entity, never on input order."""
    return F.sha2(F.concat(F.lit(f"{seed}:{label}:" if label else f"{seed}:"), key), 256)


def claim_key(field: Column, subject: Column, period: Column) -> Column:
    """Identity of a claim; the value is left out so that a change keeps its key."""
    return F.concat_ws("|", field, F.nullif(subject, F.lit("")), F.nullif(period, F.lit("")))
