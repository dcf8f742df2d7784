"""Scores as Column expressions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Profile:
    """Parameters of a domain that change results; the defaults are fixed values of its standard profile."""

    decay: float = 0.05
    min_mentions: int = 3
    velocity_cap: float = 5.0
    activity_cap: float = 20.0
    max_age: int = 365
    w_velocity: float = 0.4
    w_novelty: float = 0.3
    w_activity: float = 0.3
    w_age: float = 0.6
    w_rarity: float = 0.4
    base_relation: str = "MENTIONS"


def velocity(recent: Column, previous: Column, p: Profile) -> Column:
    """Recent over previous mentions: gated to 1 below the minimum, 0 when silent, capped without a past."""
    return (
        F.when((recent > 0) & (recent < p.min_mentions), 1.0)
        .when((recent == 0) & (previous == 0), 0.0)
        .when(previous == 0, F.least(recent.cast("double"), F.lit(p.velocity_cap)))
        .otherwise(recent / F.when(previous > 0, previous))
    )


def velocity_gated(recent: Column, p: Profile) -> Column:
    return ((recent > 0) & (recent < p.min_mentions)).cast("int")


def novelty(first_seen: Column, mentions: Column, corpus: Column, as_of: str, p: Profile) -> Column:
    """Decaying age and rarity in the corpus; 0.5 without a usable first day."""
    born = F.try_to_date(F.substring(first_seen, 1, 10), "yyyy-MM-dd") if hasattr(F, "try_to_date") else F.to_date(F.substring(first_seen, 1, 10))
    age = F.greatest(F.lit(0), F.datediff(F.lit(as_of).cast("date"), born))
    rarity = F.when(corpus <= 1, F.when(mentions == 0, 1.0).otherwise(0.5)).otherwise(
        F.log(1 + corpus / (1 + mentions)) / F.log(1 + corpus.cast("double"))
    )
    return F.when(born.isNull(), 0.5).otherwise(p.w_age * F.exp(-p.decay * age) + p.w_rarity * rarity)


def trend_score(v: Column, n: Column, recent: Column, p: Profile) -> Column:
    return (
        p.w_velocity * F.least(v, F.lit(p.velocity_cap)) / p.velocity_cap
        + p.w_novelty * n
        + p.w_activity * F.least(recent.cast("double"), F.lit(p.activity_cap)) / p.activity_cap
    )


def velocity_raw(recent: Column, previous: Column) -> Column:
    return F.when(previous > 0, recent / previous)


def velocity_floor(recent: Column, previous: Column) -> Column:
    """Lower bound of the ratio of two counts, one-sided 95 percent."""
    r, q = recent + 0.5, previous + 0.5
    return F.when((recent > 0) | (previous > 0), r / q * F.exp(-1.645 * F.sqrt(1 / r + 1 / q)))


def bridge_score(out: Column, into: Column) -> Column:
    return F.when((out > 0) | (into > 0), F.sqrt((out + 1.0) * (into + 1.0)) - 1).otherwise(0.0)


def word_count(text: Column) -> Column:
    return F.size(F.filter(F.split(F.coalesce(text, F.lit("")), r"(?U)\s+"), lambda w: w != ""))


def word_count_score(w: Column) -> Column:
    return (
        F.when(w <= 0, 0.0)
        .when(w < 200, 0.5 * w / 200)
        .when(w <= 800, 0.5 + 0.5 * (w - 200) / 600)
        .when(w <= 3000, 1.0)
        .otherwise(F.greatest(F.lit(0.7), 1 - 0.1 * F.log1p((w - 3000) / 3000)))
    )


def metadata_score(title: Column, published: Column) -> Column:
    has = lambda c: F.when(F.length(F.trim(F.coalesce(c, F.lit("")))) > 0, 0.5).otherwise(0.0)
    return has(title) + has(published)


def tier_score(tier: Column) -> Column:
    return F.when(tier == 1, 1.0).when(tier == 2, 0.6).otherwise(0.3)


def signal_score(signal: Column) -> Column:
    return F.when(signal == "primary", 1.0).when(signal == "commentary", 0.8).when(signal == "community", 0.6).when(signal == "echo", 0.4).otherwise(0.5)


def recency_score(age: Column) -> Column:
    """By age in days; null means missing or unreadable."""
    return (
        F.when(age.isNull(), 0.4)
        .when(age <= 3, 1.0)
        .when(age <= 7, 1 - 0.5 * (age - 3) / 4)
        .when(age <= 14, 0.5 - 0.2 * (age - 7) / 7)
        .otherwise(0.3)
    )


def combined_score(words, meta, tier, signal, recency) -> Column:
    return 0.30 * words + 0.20 * meta + 0.20 * tier + 0.15 * signal + 0.15 * recency
