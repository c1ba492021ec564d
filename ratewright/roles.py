"""Column roles: which columns of a table play entity, opponent, season and so on.  Operators take roles, not names."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Roles:
    season: str = "season"
    period: str = "period"
    entity: str = "offense"
    opponent: str = "defense"
    measure: str = "measure"
    weight: str = "volume"
    player: str = "player"
    game: str = "game_id"
