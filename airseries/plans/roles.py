"""Player table to role vectors, for the one-vs-rest classifier."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airseries.functions.bands import PLAYER_ROLES, ROLE_CODES, encode_labels, group_values
from airseries.operators.clean import drop_missing
from airseries.operators.columns import PLAYER_RENAMES, rename_present, select_present
from airseries.operators.encode import assemble

# Clubs of the top leagues.
TOP_CLUBS = [
    "Manchester City",
    "Liverpool",
    "Chelsea",
    "Arsenal",
    "Manchester United",
    "Tottenham Hotspur",
    "Real Madrid",
    "FC Barcelona",
    "Atlético Madrid",
    "Sevilla FC",
    "Villarreal CF",
    "Juventus",
    "Inter",
    "AC Milan",
    "Napoli",
    "AS Roma",
    "Bayern Munich",
    "Borussia Dortmund",
    "RB Leipzig",
    "Bayer 04 Leverkusen",
    "Paris Saint-Germain",
    "Olympique Lyonnais",
    "AS Monaco",
    "Marseille",
]


def role_vectors(players: DataFrame, clubs: Sequence[str] = TOP_CLUBS) -> tuple[DataFrame, list[str]]:
    """Players of the clubs with role, numeric label and skill vector; and the skills used.

    Skills that are absent are left out, missing values count as 0.0, positions
    outside the roles are dropped. ``ValueError`` if the position column is missing.
    """
    chosen = players.filter(F.col("Club").isin(*clubs))
    chosen = rename_present(
        select_present(chosen, list(PLAYER_RENAMES), required=["BP"]), PLAYER_RENAMES
    )
    skills = [c for c in chosen.columns if c != "BP"]
    roles = drop_missing(chosen.withColumn("RoleGroup", group_values("BP", PLAYER_ROLES)), "RoleGroup")
    labelled = roles.withColumn("label", encode_labels("RoleGroup", ROLE_CODES))
    return assemble(labelled, skills, missing="zero"), skills
