"""Column maintenance: names, selection, guards."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def quoted(name: str) -> str:
    """A column name as an identifier, for names with dots or spaces."""
    return "`" + name.replace("`", "``") + "`"


def sanitize_columns(df: DataFrame, old: str = ".", new: str = "_") -> DataFrame:
    """Replace ``old`` by ``new`` in all column names, in one projection."""
    return df.toDF(*[c.replace(old, new) for c in df.columns])


def rename_present(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Rename by map; names that are absent are passed over."""
    return df.withColumnsRenamed({k: v for k, v in names.items() if k in df.columns})


def select_present(
    df: DataFrame, wanted: Sequence[str], required: Sequence[str] = ()
) -> DataFrame:
    """The wanted columns that exist, in the wanted order; ``ValueError`` if a required one is missing."""
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"required columns are missing: {missing}")
    return df.select(*[F.col(quoted(c)) for c in wanted if c in df.columns])


def drop_present(df: DataFrame, *names: str) -> DataFrame:
    """Drop columns; absent ones are passed over."""
    return df.drop(*names)


# Skill columns of the player table and their names without spaces.
PLAYER_SKILLS = [
    "Crossing",
    "Finishing",
    "Heading Accuracy",
    "Short Passing",
    "Volleys",
    "Dribbling",
    "Curve",
    "FK Accuracy",
    "Long Passing",
    "Ball Control",
    "Acceleration",
    "Sprint Speed",
    "Agility",
    "Reactions",
    "Balance",
    "Shot Power",
    "Jumping",
    "Stamina",
    "Strength",
    "Long Shots",
    "Aggression",
    "Interceptions",
    "Positioning",
    "Vision",
    "Penalties",
    "Composure",
    "Marking",
    "Standing Tackle",
    "Sliding Tackle",
    "GK Diving",
    "GK Handling",
    "GK Kicking",
    "GK Positioning",
    "GK Reflexes",
]
PLAYER_RENAMES = {c: c.replace(" ", "_") for c in [*PLAYER_SKILLS, "BP"]}
